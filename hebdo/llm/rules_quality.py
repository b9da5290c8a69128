"""Quality classifier: a sparse rule ensemble over text statistics.

``text_statistics`` computes the statistics with SQL functions over the whole
text. ``fit`` grows a small random forest on them, turns every root-to-node
path into a conjunctive rule, weighs the rules with an L1-penalised logistic
regression, and keeps those with a non-zero weight. ``RuleModel.score``
compiles them into one Spark column expression: scoring has no Python.

Defined results: null and empty texts, and texts of white space alone, have
all statistics 0 and are scored like any other (between 0 and 1). Repeated
rows and ids are scored row by row. With no usable training row, or one class
only, the model has no rules and scores the class share (0.5 for none). Extra columns of the
input are carried along; a clashing name is never read, only replaced by the
operator's own columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import id_bucket, labelled_sample, stage

#: Bound on the labelled rows a model is fitted on.
MAX_TRAIN = 20_000
THRESHOLD = 0.3


def _share(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0)).cast("double")


def _without(text: Column, cls: str) -> Column:
    return F.length(F.regexp_replace(text, cls, ""))


def text_statistics(text: str | Column) -> dict[str, Column]:
    """Named statistics of a text, each a double, 0 where undefined."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    n = F.length(t)
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda w: w != "")
    nw, nl = F.size(words), F.size(lines)
    letters = n - _without(t, r"\p{L}+")
    return {
        "n_words": nw.cast("double"),
        "word_length": _share(n, nw),
        "distinct_words": _share(F.size(F.array_distinct(words)), nw),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), nl),
        "words_per_line": _share(nw, nl),
        "letters": _share(letters, n),
        "capitals": _share(n - _without(t, r"\p{Lu}+"), letters),
        "digits": _share(n - _without(t, r"\p{Nd}+"), n),
        "bars": _share(n - _without(t, r"\|+"), nw),
        "symbol_runs": _share(n - _without(t, r"[#$%&*!?=~^<>_+-]{2,}"), nw),
        "sentence_ends": _share(n - _without(t, r"[.!?]+"), nw),
        "repeats": _share(F.size(F.filter(F.zip_with(words, F.slice(words, 2, F.greatest(nw, F.lit(1))),
                                                     lambda a, b: a == b), lambda same: same)), nw),
    }


@dataclass(frozen=True)
class RuleModel:
    """rules: ((((statistic, "<=" or ">", bound), ...), weight), ...), plus an intercept."""

    rules: tuple
    intercept: float

    def score(self, stats: dict[str, Column] | None = None) -> Column:
        """The logistic score as one column expression over ``stats`` columns."""
        col = (lambda s: stats[s]) if stats else F.col
        z = F.lit(float(self.intercept))
        for conds, weight in self.rules:
            z = z + F.when(rule_column(conds, col), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-z))


def rule_column(conds: tuple, col) -> Column:
    out = None
    for stat, op, bound in conds:
        c = col(stat) <= bound if op == "<=" else col(stat) > bound
        out = c if out is None else out & c
    return out


def tree_paths(debug: str, names: list[str]) -> set[tuple]:
    """Conjunctions on the paths of a printed decision tree, inner nodes included."""
    found, path = set(), []
    for line in debug.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.eE+]+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (names[int(m[2])], m[3], float(m[4])))]
        found.add(tuple(sorted(set(c for _, c in path))))
    return found


def fit(sample: DataFrame, trees: int = 16, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> RuleModel:
    """Rules and weights from (text, label) rows; ``sample`` must be bounded."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    stats = text_statistics("text")
    names = list(stats)
    table = stage(sample.select(F.col("label").cast("double").alias("label"),
                                *[c.alias(n) for n, c in stats.items()]), "rule-statistics")
    n, pos = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or pos in (0, n):
        import math
        share = (pos + 1) / (n + 2)
        return RuleModel((), math.log(share / (1 - share)))
    vec = VectorAssembler(inputCols=names, outputCol="_x").transform(table)
    forest = RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=trees, maxDepth=depth,
                                    minInstancesPerNode=5, seed=seed).fit(vec)
    paths = sorted(set().union(*(tree_paths(t.toDebugString, names) for t in forest.trees)))
    rules = [F.when(rule_column(p, F.col), 1.0).otherwise(0.0).alias(f"r{i}") for i, p in enumerate(paths)]
    flags = stage(table.select("label", *rules), "rule-flags")
    vec = VectorAssembler(inputCols=[f"r{i}" for i in range(len(paths))], outputCol="_x").transform(flags)
    lasso = LogisticRegression(featuresCol="_x", labelCol="label", elasticNetParam=1.0, regParam=penalty,
                               standardization=False, maxIter=60).fit(vec)
    kept = tuple((p, float(w)) for p, w in zip(paths, lasso.coefficients) if w != 0.0)
    return RuleModel(kept, float(lasso.intercept))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> RuleModel:
    """Fit on labelled rows outside the held-out fold (crc32 of the id mod 5 = 0)."""
    return fit(labelled_sample(docs, labels, "quality", 5, 0, max_train))


def score(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, predicted, held_out (its own columns of these names are replaced)."""
    p = model.score(_stat_columns())
    work = docs.withColumn("_stats", F.struct(*[c.alias(n) for n, c in text_statistics("text").items()]))
    return (work.withColumn("score", p).drop("_stats")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .withColumn("held_out", F.coalesce(id_bucket("doc_id", 5) == 0, F.lit(False))))


def _stat_columns() -> dict[str, Column]:
    return {n: F.col(f"_stats.{n}") for n in text_statistics(F.lit(""))}
