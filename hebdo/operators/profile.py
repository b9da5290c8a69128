"""Schema conformance, data-quality profiles and de-duplication.

The mapping from raw headers to internal roles is decided from
``df.schema`` on the driver (metadata only); the data work is a single
``select`` of ``try_cast`` expressions, and every profile is one aggregate
pass over the table followed by a tiny stack of per-column rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.functions.cleaning import clean_header, fill_zero_int, round_half_up as R

# Alias candidates per analysis role (first existing column
# wins), then regex patterns tried in order.
ROLE_ALIASES = {
    "commune": (("comunaglosa", "comuna", "comuna_nombre", "nom_comuna"), (r"comuna",)),
    "date": (("fecha", "f_evento", "f_semana", "fecha_semana"),
             (r"fecha", r"^f_.*", r"semana", r"^anio$", r"^año$", r"^ano$", r"^year$")),
    "week": (("semanaestadistica", "semana", "semana_epidemiologica", "nsemana"), (r"semana",)),
    "year": (("anio", "año", "ano", "year"), (r"^a[ñn]o$", r"^anio$", r"year")),
    "establishment": (("establecimientoglosa", "establecimiento", "tipo_establecimiento"),
                      (r"estable", r"sapu|sar|hospital|clinica|urgenc")),
    "cause": (("causa", "diagnostico", "causa_respiratoria", "categoria"), (r"causa", r"diagn", r"respir")),
    "age_group": (("grupo_etario", "edad_grupo", "grupoedad", "grupo_etario_desc"), (r"edad", r"etario")),
    "total": (("numtotal", "total", "casos", "n_casos", "cantidad", "conteo"), (r"total|casos|cantidad|conteo",)),
}

# Internal name and type of each required raw column ("count" = NULL->0 BIGINT).
RAW_INTERNAL = {
    "establecimientocodigo": ("estab_code", "bigint"),
    "establecimientoglosa": ("estab_label", "string"),
    "regioncodigo": ("region_code", "bigint"),
    "regionglosa": ("region_label", "string"),
    "comunacodigo": ("commune_code", "bigint"),
    "comunaglosa": ("commune_label", "string"),
    "serviciosaludcodigo": ("service_code", "bigint"),
    "serviciosaludglosa": ("service_label", "string"),
    "tipoestablecimiento": ("estab_type", "string"),
    "dependenciaadministrativa": ("admin_dependency", "string"),
    "nivelatencion": ("care_level", "string"),
    "tipourgencia": ("emergency_type", "string"),
    "nivelcomplejidad": ("complexity_level", "string"),
    "latitud": ("latitude", "double"),
    "longitud": ("longitude", "double"),
    "anio": ("year", "int"),
    "semanaestadistica": ("week", "int"),
    "ordencausa": ("cause_code", "bigint"),
    "causa": ("cause", "string"),
    "numtotal": ("total", "count"),
    "nummenor1anio": ("band_under1", "count"),
    "num1a4anios": ("band_1_4", "count"),
    "num5a14anios": ("band_5_14", "count"),
    "num15a64anios": ("band_15_64", "count"),
    "num65omas": ("band_65_plus", "count"),
}


#: Analysis role of ``ROLE_ALIASES`` that a required column fills, where it has one.
COLUMN_ROLE = {"comunaglosa": "commune", "semanaestadistica": "week", "anio": "year", "establecimientoglosa": "establishment",
               "causa": "cause", "numtotal": "total"}
#: Patterns over cleaned headers for the columns without a role, tried in order; code before label.
CODE, LABEL = r"(?:c[oó]d(?:igo)?|id|code)", r"(?:glosa|nombre|nom|desc(?:ripci[oó]n)?|label|name)"


def _pair(subject: str, what: str) -> tuple[str, ...]:
    return (rf"^{what}.*{subject}", rf"{subject}.*{what}")


COLUMN_PATTERNS = {
    "establecimientocodigo": _pair("estab", CODE), "establecimientoglosa": _pair("estab", LABEL),
    "regioncodigo": _pair("regi[oó]n", CODE), "regionglosa": (*_pair("regi[oó]n", LABEL), r"^regi[oó]n$"),
    "comunacodigo": _pair("comuna", CODE), "comunaglosa": (*_pair("comuna", LABEL), r"^comuna$"),
    "serviciosaludcodigo": _pair("servicio", CODE), "serviciosaludglosa": (*_pair("servicio", LABEL), r"^servicio(?:_?(?:de_)?salud)?$"),
    "tipoestablecimiento": (r"tipo.*estab", r"estab.*tipo"), "dependenciaadministrativa": (r"dependencia",),
    "nivelatencion": (r"nivel.*atenci[oó]n",), "tipourgencia": (r"tipo.*urgencia",),
    "nivelcomplejidad": (r"(?:nivel.*)?complejidad",), "latitud": (r"^lat(?:itud|itude)?$",), "longitud": (r"^(?:lon|lng)(?:gitud|gitude)?$",),
    "ordencausa": (r"orden.*causa", *_pair("causa", CODE)), "causa": (*_pair("causa", LABEL), r"^causa$"),
    "nummenor1anio": (r"menor(?:es)?.*1", r"<_?1"), "num1a4anios": (r"1_?(?:a|to|-)?_?4(?!\d)",),
    "num5a14anios": (r"5_?(?:a|to|-)?_?14",), "num15a64anios": (r"15_?(?:a|to|-)?_?64",), "num65omas": (r"65",),
}
#: Without these no fact can be built.
REQUIRED = ("establecimientocodigo", "anio", "semanaestadistica", "ordencausa", "numtotal")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column to its cleaned header (metadata-only projection).

    Of headers that are equal when cleaned the first keeps the name; later ones get _2, _3 and so on.
    """
    names: list[str] = []
    for c in df.columns:
        clean = name = clean_header(c)
        k = 1
        while name in names:
            k += 1
            name = f"{clean}_{k}"
        names.append(name)
    return df.toDF(*names)


def resolve_columns(columns: list[str], wanted=tuple(RAW_INTERNAL)) -> dict[str, tuple[str | None, str]]:
    """wanted column -> (cleaned header, how): the header itself, else a known alias, else the first pattern that hits.

    Each way is tried for all columns before the next, so a pattern never takes a header
    that another column claims by name; a header is given once. ``how`` is header, alias, pattern or absent.
    """
    out: dict[str, tuple[str | None, str]] = {}
    free = list(columns)

    def claim(src: str, hit: str | None, how: str) -> None:
        if hit is not None:
            out[src] = hit, how
            free.remove(hit)

    for src in wanted:
        claim(src, src if src in free else None, "header")
    for src in wanted:
        if src not in out:
            aliases = ROLE_ALIASES[COLUMN_ROLE[src]][0] if src in COLUMN_ROLE else ()
            claim(src, next((a for a in aliases if a in free), None), "alias")
    for src in wanted:
        if src not in out:
            patterns = (*COLUMN_PATTERNS.get(src, ()), *(ROLE_ALIASES[COLUMN_ROLE[src]][1] if src in COLUMN_ROLE else ()))
            claim(src, next((c for p in patterns for c in free if re.search(p, c, re.IGNORECASE)), None), "pattern")
    return {src: out.get(src, (None, "absent")) for src in wanted}


def resolve_roles(columns: list[str], aliases=ROLE_ALIASES) -> dict[str, str | None]:
    """role -> column: first existing alias, else first regex hit in pattern order.

    A column already claimed by an earlier role is not offered again.
    """
    claimed: set[str] = set()
    out: dict[str, str | None] = {}
    for role in ("total", "year", "week", "commune", "establishment", "cause", "age_group", "date"):
        cands, pats = aliases[role]
        hit = next((c for c in cands if c in columns and c not in claimed), None)
        if hit is None:
            for p in pats:
                rx = re.compile(p, re.IGNORECASE)
                hit = next((c for c in columns if rx.search(c) and c not in claimed), None)
                if hit:
                    break
        out[role] = hit
        if hit:
            claimed.add(hit)
    return out


def _typed(col: str, kind: str):
    c = F.col(col)
    if kind == "count":
        return fill_zero_int(c)
    if kind == "string":
        return c.cast("string")
    return F.trim(c.cast("string")).try_cast(kind)


def conform_table(raw: DataFrame, mapping=RAW_INTERNAL, required=()) -> DataFrame:
    """Headers cleaned and resolved, columns renamed to internal names and cast in one select.

    A ``required`` column that no header resolves to is an error; other columns that are
    absent are left out (``role_completeness`` lists them).
    """
    df = normalize_headers(raw)
    found = resolve_columns(df.columns, tuple(mapping))
    missing = [src for src in required if found[src][0] is None]
    if missing:
        raise ValueError(f"no column for {', '.join(missing)} among the headers {', '.join(df.columns)}")
    return df.select(*[_typed(found[src][0], kind).alias(dst) for src, (dst, kind) in mapping.items() if found[src][0]])


def role_completeness(raw: DataFrame, mapping=RAW_INTERNAL, resolved: bool = False) -> DataFrame:
    """One row per required column: present, non-null count, cast failures; one pass over the table.

    With ``resolved``, also the raw header that fills the column and how it was found (``resolve_columns``).
    """
    df = normalize_headers(raw)
    found = resolve_columns(df.columns, tuple(mapping))
    original = dict(zip(df.columns, raw.columns))
    aggs = []
    for src, (_, kind) in mapping.items():
        header = found[src][0]
        if header is None:
            continue
        c = F.col(header)
        target = "double" if kind == "count" else kind
        bad = F.lit(False) if kind == "string" else c.isNotNull() & F.trim(c.cast("string")).try_cast(target).isNull()
        aggs += [F.count(c).alias(f"nn__{src}"), F.sum(F.when(bad, 1).otherwise(0)).alias(f"cf__{src}")]
    g = df.agg(*(aggs or [F.count(F.lit(1)).alias("_")]))
    value = lambda kind, src: F.coalesce(F.col(f"{kind}__{src}") if found[src][0] else F.lit(0), F.lit(0)).cast("bigint")
    how = lambda src: [F.lit(original.get(found[src][0])).alias("raw_header"), F.lit(found[src][1]).alias("found_by")]
    rows = [F.struct(F.lit(src).alias("column_name"), *(how(src) if resolved else []), F.lit(found[src][0] is not None).alias("present"),
                     value("nn", src).alias("non_null"), value("cf", src).alias("cast_failures")) for src in mapping]
    return g.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def filter_by_city(df: DataFrame, cities: list[str], column: str = "city") -> DataFrame:
    """Rows of the named cities, and one check row for each city that has none.

    The check rows come from the same pass: the wanted names are joined to the rows that the
    filter leaves, and a name without a partner stays, with nulls and ``check`` set.
    """
    wanted = df.sparkSession.createDataFrame([(c,) for c in dict.fromkeys(cities)], f"`{column}` string")
    rows = df.filter(F.col(column).isin(list(cities))).withColumn("_found", F.lit(True))
    out = wanted.join(rows, column, "left")
    return out.withColumn("check", F.when(F.col("_found").isNull(), "no rows")).drop("_found").select(*df.columns, "check")


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def null_profile(df: DataFrame, top: int = 10) -> DataFrame:
    """Percent missing per column, descending (name breaks ties), top n."""
    aggs = [F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c) for c in df.columns]
    g = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), (F.col(f"`{c}`") * 100).alias("pct_missing")) for c in df.columns]
    st = g.select(F.explode(F.array(*rows)).alias("r")).select("r.column_name", R(F.col("r.pct_missing")).alias("pct_missing"))
    return st.orderBy(F.col("pct_missing").desc(), "column_name").limit(top)


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type name, non-null count, exact distinct count (one pass)."""
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    aggs = []
    for c in df.columns:
        aggs += [F.count(c).alias(f"nn__{c}"), F.count_distinct(c).alias(f"nd__{c}")]
    g = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                     F.col(f"nn__{c}").cast("bigint").alias("non_null"),
                     F.col(f"nd__{c}").cast("bigint").alias("n_distinct")) for c in df.columns]
    return g.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def row_col_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: rows, columns, empty flag (union of counts)."""
    out = None
    for name, t in tables.items():
        one = t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(t.columns)).alias("n_cols"),
            (F.col("n_rows") == 0).alias("is_empty"))
        out = one if out is None else out.unionByName(one)
    return out
