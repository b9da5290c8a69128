"""Near duplicates, decontamination, chat formatting, PII and SentencePiece on small frames."""

import collections
import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from hebdo.llm import bayes_jaccard as bj
from hebdo.llm import chat_prefix as chat
from hebdo.llm import phrase_index as ph
from hebdo.llm import pii_surrogate as pii
from hebdo.llm import sentencepiece_viterbi as spv
from hebdo.llm.common import read
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, edge_rows


# ---- near duplicates -------------------------------------------------------------------
def brute_links(rows):
    sets = []
    for _, t in rows:
        w = bj.WORD.findall(t.lower()) if t else []
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    links, parent = [0] * len(rows), list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            a, b = bj.root(parent, i), bj.root(parent, j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = bj.root(parent, i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return [(d, n, d if n == 0 else least[bj.root(parent, i)]) for i, ((d, _), n) in enumerate(zip(rows, links))]


def near_rows(n=220, seed=3):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(120)]
    rows = []
    for i in range(n):
        w = list(base) if i % 2 else [rng.choice(vocab) for _ in range(rng.randint(1, 150))]
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    return rows + [(1000, rows[1][1]), (1001, rows[1][1]), (1002, rows[1][1].upper())]


@pytest.mark.parametrize("block", [400, 20])  # one tile, many tiles
def test_jaccard_join_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(bj, "BLOCK", block)
    rows = near_rows()
    got = bj.jaccard_join(docs(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_links"], r["component_id"]) for r in got) == sorted(brute_links(rows))
    kept = [r["doc_id"] for r in got if r["kept"]]
    assert sorted(kept) == sorted({r["component_id"] for r in got})


def test_jaccard_join_edges(spark):
    rows = edge_rows()
    got = bj.jaccard_join(docs(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    by = collections.Counter((r["doc_id"], r["n_links"], r["component_id"]) for r in got)
    assert by[(8, 3, 7)] == 2 and by[(None, 3, 7)] == 1 and by[(None, 0, None)] == 1 and by[(2, 0, 2)] == 1
    kept = bj.keep_one(docs(spark, rows, clash=True))
    assert kept.columns == docs(spark, rows, clash=True).columns
    assert sorted((str(r["doc_id"]), r["text"] is None) for r in kept.collect()) == sorted(
        (str(i), t is None) for i, t in rows if t != rows[6][1] or i == 7)
    assert bj.jaccard_join(docs(spark, [])).count() == 0 and bj.keep_one(docs(spark, [])).count() == 0


def test_repeated_row_leaves_one(spark):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "a b c d e f g h")]
    assert [r["doc_id"] for r in bj.keep_one(docs(spark, rows)).collect()] == [1]


def test_pruning_never_drops_a_likely_pair():
    need = bj.least_matches(192)
    assert list(need) == [32, 64, 96, 128, 160, 192]
    assert all(0 < need[n] < 0.8 * n for n in need) and need[192] / 192 > need[32] / 32


# ---- decontamination -------------------------------------------------------------------
def brute_contamination(rows, items, size=13):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: word.findall(t.encode().lower()) if t else []  # noqa: E731 - bytes.lower() is A-Z only
    phrases = [(i, cut(t)) for i, t in items if i is not None]
    out = []
    for d, t in rows:
        w, hit, found = cut(t), set(), set()
        for i, p in phrases:
            n = min(size, len(p))
            wins = {tuple(p[k:k + n]) for k in range(len(p) - n + 1)} if n else set()
            for s in range(len(w) - n + 1 if n else 0):
                if tuple(w[s:s + n]) in wins:
                    hit.update(range(s, s + n))
                    found.add(str(i))
        names = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_words,chunk_words", [(400_000, 2_000_000), (50, 20)])
def test_contamination_matches_brute_force(spark, block_words, chunk_words):
    rng = random.Random(5)
    vocab = ["the", "of", "Ünd", "Ä", "x1"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([1, 3, 13, 14, 40, 0])]
    items += [(7, items[4][1]), (10, None), (None, "the of")]
    rows = edge_rows() + [(100 + i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(200, f"before, {items[4][1].upper()}; after"), (201, items[3][1].replace(" ", "-"))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = ph.build_index(docs(spark, rows, clash=True), block_words)
    got = ph.contamination(ph.search(index, bench, chunk_words=chunk_words)).drop("key", "n_near", "n_near_items", "near_sha256").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_contamination(rows, items)))


def brute_near(rows, items, within):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: [x.decode() for x in word.findall(t.encode().lower())] if t else []
    texts = [cut(t) for _, t in rows]
    count = collections.Counter(w for t in texts for w in t)
    bags = {(i, tuple(cut(t))) for i, t in items if i is not None and cut(t)}
    out = []
    for (d, _), w in zip(rows, texts):
        found, n = set(), 0
        for i, p in bags:
            first, *others = sorted(set(p), key=lambda t: (count[t], t))
            for k in (k for k, x in enumerate(w) if x == first):
                if set(others) <= set(w[max(0, k - within):k + within + 1]):
                    found.add(str(i))
                    n += 1
        out.append((d, sorted(found), n))
    return out


@pytest.mark.parametrize("block_words,chunk_words,within", [(400_000, 2_000_000, 3), (40, 2_000_000, 6), (40, 15, 1)])
def test_proximity_matches_brute_force(spark, block_words, chunk_words, within):
    rng = random.Random(9)
    vocab = ["the", "of", "Ünd", "Ä", "x1", "rare", "odd"]
    rows = [(i, " ".join(rng.choices(vocab, (9, 9, 5, 5, 3, 1, 1), k=rng.randrange(40)))) for i in range(80)] + edge_rows()
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 4)))) for i in range(25)]
    items += [(3, "the OF"), (None, "the"), (30, None), (31, "!"), (32, "absent the"), (33, "the the of"), (34, "of the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    if chunk_words < 100:  # the rarest term is counted over the whole index whatever the slice
        assert ph.cut_phrases(bench, 0, within).count() > chunk_words
    got = ph.proximity(ph.build_index(docs(spark, rows, clash=True), block_words), bench, within, chunk_words).collect()
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], r["items"], r["n_near"]) for r in got), key=key) == sorted(brute_near(rows, items, within), key=key)


def test_proximity_and_empty_tables(spark):
    rows = [(1, "alpha x x beta"), (2, "beta x alpha"), (3, "alpha x x x x x beta"), (4, "alpha"), (5, "x beta alpha")]
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    index = ph.build_index(docs(spark, rows))
    got = {r["doc_id"] for r in ph.proximity(index, bench, 3).collect() if r["items"]}
    assert got == {1, 2, 5}
    none = spark.createDataFrame([], "item_id long, text string")
    assert ph.contamination(ph.search(index, none)).filter("n_hit = 0 and not contaminated").count() == 5
    assert ph.search(ph.build_index(docs(spark, [])), bench).count() == 0


# ---- chat formatting -------------------------------------------------------------------
def conv(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_prefix_targets(spark):
    df = conv(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "a<|b"), (1, 2, "user", "\\s"), (1, 3, "assistant", ""),
                      (1, 4, "user", "bye")]).withColumn("head", F.lit("mine"))
    got = chat.format_examples(df).orderBy("example").collect()
    assert [r["n_turns"] for r in got] == [2, 4, 5]
    assert got[0]["formatted"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na\\lb<|im_end|>\n"
    masked = [r["formatted"][r["target_start"]:r["target_start"] + r["target_chars"]] for r in got[:2]]
    assert masked == ["a\\lb", ""] and got[2]["target_start"] is None
    assert got[2]["formatted"].startswith(got[1]["formatted"]) and got[1]["formatted"].startswith(got[0]["formatted"])


def test_chat_round_trip_with_hostile_texts(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "\\l\\s\\n\\", "a\nb\r\n", "<|<|", "", None, "\\", "\U0001f600<|im_end|>\n", "user\nx"]
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate(zip(["user", "assistant", "sys\ntem\\n", None, "assistant"] * 2, nasty))]
    rows += [(3, 0, "user", "no reply"), (4, 5, "assistant", "b"), (4, 5, "assistant", "a"), (4, 5, "assistant", "a"), (4, None, "user", "c")]
    got = {r["conv_id"]: r for r in chat.summarise(chat.format_examples(conv(spark, rows))).collect()}
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = sorted(turns)
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.summarise(chat.format_examples(conv(spark, []))).count() == 0


# ---- PII -------------------------------------------------------------------------------
TEXT = ("Write to Ann.Lee+x@mail.example.com or ann.lee+X@mail.example.com, call +1 (415) 555-2671 or +1 415 555 2671. "
        "Card 4111 1111 1111 1111, host 10.2.3.44, token = \"1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae\". "
        "Mrs. Clara Schmidt met Mr. Schmidt and Господин Петров.")


def one_text(spark, text, key="k"):
    return pii.replace(docs(spark, [(1, text)]), key).first()


def test_surrogates_keep_type_form_and_coreference(spark):
    r = one_text(spark, TEXT)
    new = r["text"]
    assert r["n_entities"] == 10
    mails = re.findall(r"[\w.+]+@[\w.]+", new)
    assert mails[0].lower() == mails[1].lower() and re.fullmatch(r"[a-z]{3}\.[a-z]{3}\+[a-z]@[a-z]{4}\.[a-z]{7}\.com", mails[0])
    phones = re.findall(r"\+1[ ()0-9-]+\d", new)
    assert [re.sub(r"\D", "", p) for p in phones][0] == re.sub(r"\D", "", phones[1]) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phones[0])
    card = re.search(r"Card (\d{4} \d{4} \d{4} \d{4}),", new)[1].replace(" ", "")
    assert card[0] == "4" and sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(card)) % 10 == 0
    assert all(0 < int(o) < 255 for o in re.search(r"host (\d+\.\d+\.\d+\.\d+),", new)[1].split("."))
    assert re.search(r'token = "[0-9a-f]{40}"', new)
    given, family = re.search(r"Mrs\. (\w+) (\w+) met", new).groups()
    assert given in pii.GIVEN["f", "latin"] and re.search(r"Господин [А-Я][а-я]+\.", new)
    for private in ("Ann.Lee", "415", "4111 1111", "10.2.3.44", "1beb58", "Schmidt", "Петров"):
        assert private not in new
    assert new.startswith("Write to ") and one_text(spark, TEXT)["text"] == new != one_text(spark, TEXT, "other")["text"]


def test_surrogates_stay_distinct(spark):
    """256 octet pairs map into few values: collisions must be found and resolved, across documents."""
    rows = [(i, f"from 10.0.{i % 250}.{i // 250 + 1} and Mr. {a}{b}") for i, (a, b) in enumerate(
        itertools.product(["Ba", "Ko", "Lu", "Me", "Ni"] * 8, ["rt", "lm", "nd", "ss", "ck"]))]
    df = docs(spark, rows)
    got = [r["text"] for r in pii.replace(df, "k").orderBy("doc_id").collect()]
    pair = [re.search(r"from (\S+) and (Mr\. \S+)", t).groups() for t in got]
    assert len({p for p, _ in pair}) == len({t.split()[1] for _, t in rows})
    names = collections.defaultdict(set)
    for (_, t), (_, new) in zip(rows, pair):
        names[t.split()[-1]].add(new)
    assert all(len(v) == 1 for v in names.values()) and len({n for v in names.values() for n in v}) == len(names)


def test_forced_collisions_are_resolved(spark, monkeypatch):
    """With sixteen names for six entities most names clash at first; every entity still ends with its own surrogate."""
    monkeypatch.setitem(pii.SYLLABLES, "latin", ["ba", "den"] * 8)
    rows = [(i, f"Mr. {c}ool and Mr. {c}ool") for i, c in enumerate("ABCDEF")]
    exceptions = pii.collisions(pii.entities(pii.cut_texts(docs(spark, rows))[0]), "k")
    assert exceptions.count() > 0
    got = [r["text"] for r in pii.replace(docs(spark, rows), "k").collect()]
    assert all(t.split(" and ")[0] == t.split(" and ")[1] for t in got) and len(set(got)) == 6


def test_one_entity_gets_one_surrogate_in_every_form(spark):
    rows = [(1, "+1 (415) 555-2671"), (2, "+14155552671"), (3, "+1-415-555-2671"), (4, "Mr. John Smith"), (5, "Dr. John Smith"),
            (6, "Dr. Ann Lee"), (7, "Prof. Ann Lee"), (8, "Mrs. Kim Roe"), (9, "Mr. Kim Roe"), (10, "Dr. Kim Roe"), (11, "Mr. Al Po")]
    got = {r["doc_id"]: r["text"] for r in pii.replace(docs(spark, rows), "k").collect()}
    digits = {re.sub(r"\D", "", got[i]) for i in (1, 2, 3)}
    assert len(digits) == 1 and digits.pop()[0] == "1" and got[2].startswith("+1") and len(got[2]) == 12
    name = {i: got[i].split(" ", 1)[1] for i in range(4, 12)}
    assert name[4] == name[5] and name[6] == name[7] and name[8] == name[9] == name[10] and len(set(name.values())) == 4
    for i, gender in ((5, "m"), (6, "u"), (8, "u"), (11, "m")):
        assert name[i].split()[0] in pii.GIVEN[gender, "latin"]
    assert all(got[i].split()[0] == t.split()[0] for i, t in rows[3:])


@pytest.mark.parametrize("number", ["+33 1 23 45 67 89", "06 12 34 56 78", "01.23.45.67.89", "0612345678", "+49 30 12345678", "0171 2345678",
                                    "030/12345678", "(030) 12345678", "+49 (0)30 123456", "+34 91 123 45 67", "912 345 678", "612 34 56 78",
                                    "91 123 45 67"])
def test_telephone_forms_of_four_languages(number):
    typed = [t for t in ("secret", "email", "card", "ip", "phone") if _java(pii.PATTERNS[t]).fullmatch(number)]
    assert typed == ["phone"]
    hits = [m[0] for m in _java(pii.PATTERNS["phone"]).finditer(f"Tel. {number}, 01.02.2003 10:30, 2003-01-02 04:05, 3.0612345678, 12 345 67")]
    assert hits == [number]


def _java(pattern):
    return re.compile(pattern.replace("(?<gap>", "(?P<gap>").replace("\\k<gap>", "(?P=gap)"))


def test_telephone_surrogates_keep_code_and_layout(spark):
    rows = [(1, "call +33 1 23 45 67 89."), (2, "call 06 12 34 56 78."), (3, "call 0171 2345678."), (4, "+33123456789"), (5, "on 01.02.2003 10:30")]
    got = {r["doc_id"]: r["text"] for r in pii.replace(docs(spark, rows), "k").collect()}
    assert re.fullmatch(r"call \+33 \d(?: \d\d){4}\.", got[1]) and re.fullmatch(r"call 0\d(?: \d\d){4}\.", got[2])
    assert re.fullmatch(r"call 0\d{3} \d{7}\.", got[3]) and re.sub(r"\D", "", got[1]) == got[4][1:] and got[5] == rows[4][1]
    assert all(got[i] != t for i, t in rows[:4])


def test_more_names_than_four_syllables_hold_are_resolved(spark, monkeypatch):
    """Two syllables give 16 family names of four; 60 entities need longer ones."""
    monkeypatch.setitem(pii.SYLLABLES, "latin", ["ba", "den"] * 8)
    rows = [(i, f"Mr. {a}{b}") for i, (a, b) in enumerate(itertools.product("ABCDEFGHIJ", ["ool", "ill", "ock", "arn", "eft", "und"]))]
    got = [r["text"] for r in pii.replace(docs(spark, rows), "k").collect()]
    assert len(set(got)) == len(rows) == 60 and all(t.startswith("Mr. ") for t in got) and not set(got) & {t for _, t in rows}


def test_every_address_of_a_full_layout_is_replaced(spark):
    """All 676 addresses of one short layout: no value of the layout is free, so the surrogates grow."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"write to {a}@{b}.de") for i, (a, b) in enumerate(itertools.product(letters, letters))]
    rows += [(1000 + i, f"token = {i:08d}") for i in range(40)]
    got = [r["text"] for r in pii.replace(docs(spark, rows), "k").collect()]
    mails = [re.search(r"\S+@\S+", t)[0] for t in got if "@" in t]
    assert len(set(mails)) == 676 and not {f"write to {m}" for m in mails} & {t for _, t in rows}
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.de", m) for m in mails)


@pytest.mark.parametrize("piece,n", [("a@", 1), ("b.", 500_000), ("a@b.", 250_000), ("1 ", 500_000), ("1-", 500_000), ("+1 ", 300_000),
                                     ("token ", 160_000), ("token=", 160_000), ("Mr ", 330_000), ("Frau Ä", 160_000), ("Xx-", 330_000),
                                     ("1.", 500_000), ("a" * 40 + " ", 25_000), ("(0", 500_000), ("@", 1_000_000), ("x", 1_000_000)])
def test_long_adversarial_texts_end(spark, piece, n):
    few = piece * (n // 20)
    for text in (piece * n, "a@" + few, "password: " + few, "Mr. " + few):
        out = spark.createDataFrame([(text,)], "text string").select(F.size(pii.mentions(pii.pieces(F.col("text")))).alias("n")).first()
        assert out["n"] >= 0


def test_a_form_of_address_is_no_name(spark):
    text = "Frau Müller Herr Schmidt kamen. Mr Smith Ms Jones came. Mr. Frau Weber. Dr. Dr. Lang and Miss Missy Sr."
    new = one_text(spark, text)["text"]
    for name in ("Müller", "Schmidt", "Smith", "Jones", "Weber", "Lang", "Missy"):
        assert name not in new
    assert re.fullmatch(r"Frau \w+ Herr \w+ kamen\. Mr \w+ Ms \w+ came\. Mr\. Frau \w+\. Dr\. Dr\. \w+ and Miss \w+ Sr\.", new)


def test_surrogates_match_a_plain_version(spark):
    """Which spans are replaced, and the digit and letter rule, in plain Python."""
    import hashlib
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    java = re.compile("|".join(f"(?:{p})" for p in pii.PATTERNS.values()).replace("(?<gap>", "(?P<gap>").replace("\\k<gap>", "(?P=gap)")
                      .replace(r"\p{Lu}", "[A-ZÀ-ÖØ-ÞА-Я]").replace(r"\p{Ll}", "[a-zß-öø-ÿа-я]").replace(r"\p{L}", "[^\\W\\d_]"))
    mapped = 0
    got = {r["doc_id"]: r["text"] for r in pii.replace(docs(spark, rows), "k").collect()}
    exceptions = {(r["type"], r["norm"]) for r in pii.collisions(pii.entities(pii.cut_texts(docs(spark, rows))[0]), "k").collect()}
    mail = re.compile("(?:" + pii.PATTERNS["email"] + r")\Z")
    for i, t in rows:
        new, at, end = got[i] or "", 0, 0
        for m in java.finditer(t or ""):
            gap = t[end:m.start()]
            assert new.startswith(gap, at), (i, m[0])
            at, end = at + len(gap), m.end()
            if mail.match(m[0]) and ("email", m[0].lower()) not in exceptions:
                norm, tail = m[0].lower(), re.search(r"(\.[a-z]{2,})$", m[0].lower())[1]
                digest = hashlib.sha512("\x1f".join(("k", "email", norm, "0")).encode()).hexdigest()
                want = ""
                for k, c in enumerate(norm[:-len(tail)]):
                    seed = hashlib.sha512(f"{digest}{k // 31}".encode()).hexdigest()
                    v = int(seed[k % 31 * 4:k % 31 * 4 + 4], 16)
                    want += str(v % 10) if c.isdigit() else chr(97 + v % 26) if "a" <= c <= "z" else c
                assert new.startswith(want + tail, at)
                at += len(want + tail)
                mapped += 1
            else:  # its length is the surrogate's own; the next gap is looked for behind it
                nxt = java.search(t, end)
                gap = t[end:nxt.start() if nxt else len(t)]
                at = new.index(gap, at + 1) if gap else at + len(m[0])
        assert new[at:] == (t or "")[end:]
    assert mapped


@pytest.mark.parametrize("text", [
    "", "a", "x@y.de", "to x@y.de and q@r.fr.", "\0", "\0x@y.de\0", "a\0b x@y.de x@y.de \0\0 1.2.3.4", "Mr John Smith\n+1 (415) 555-2671", "$0 \\ x@y.de $1"])
def test_pieces_are_gaps_and_mentions_in_turn(spark, text):
    row = spark.createDataFrame([(text,)], "text string").select(
        pii.pieces(F.col("text")).alias("cut"), F.regexp_extract_all("text", F.lit(pii.ANY), F.lit(0)).alias("found")).first()
    assert "".join(row["cut"]) == text and row["cut"][1::2] == row["found"] and len(row["cut"]) % 2 == 1
    new = one_text(spark, text)
    assert new["n_entities"] == len(row["found"]) and (new["text"] == text) == (not row["found"])


def test_patterns_see_a_text_once(spark):
    """Entities and the rewriting read the staged pieces: no pattern runs over texts in their plans."""
    work, gaps, found = pii.cut_texts(docs(spark, [(1, "to x@y.de"), (2, "none"), (3, None)]))
    assert [(r["text"], r[gaps], r[found] and len(r[found])) for r in work.orderBy("doc_id").collect()] == [
        (None, ["to ", ""], 1), ("none", None, None), (None, None, None)]
    for plan in (pii.entities(work, found), pii.replace(docs(spark, [(1, "to x@y.de"), (2, "none")]), "k")):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" not in text and "\0$0\0" not in text


def test_pii_edges(spark):
    rows = edge_rows()
    df = docs(spark, rows, clash=True)
    got = pii.replace(df, "k")
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got.collect()))) == sorted(map(str, rows))
    assert got.columns == [*df.columns, "n_entities"] and got.filter("_m = 'mine' and _k = 'mine' and _bumps = 'mine'").count() == len(rows)
    forced = pii.replace(docs(spark, [(i, f"{c}@y.de") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")], clash=True), "k")
    assert forced.filter("_m = 'mine' and _k = 'mine' and _bumps = 'mine'").count() == 26
    assert pii.replace(docs(spark, []), "k").count() == 0


# ---- SentencePiece ---------------------------------------------------------------------
def test_ids_equal_the_library_and_decode_back(spark):
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=spv.MODEL)
    rng = random.Random(2)
    texts = [t for _, t in edge_rows()] + ["  two  blanks ", "a" * 3000, "\x00\x01", "aaaaaaab" * 9, "\n\n \n", "ab cd"]
    texts += ["".join(rng.choice("abtheoing  \nÜ漢é.,") for _ in range(rng.randint(1, 200))) for _ in range(150)]
    df = docs(spark, list(enumerate(texts)), clash=True)
    got = {r["doc_id"]: r for r in spv.decode(spv.encode(df)).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i]["ids"] is None and got[i]["text_back"] is None
            continue
        assert got[i]["ids"] == m.encode(t), t[:50]
        assert got[i]["text_back"] == t.replace(spv.MARK, " ")
    assert spv.encode(docs(spark, [])).count() == 0


def test_shared_prefix_states_equal_separate_encoding():
    data = open(spv.MODEL, "rb").read()
    words = ["▁the", "▁then", "▁them", "▁theme", "▁other", "▁otherwise", "▁▁x", "▁"]
    shared, lone = spv.Pieces(data), spv.Pieces(data)
    shared.encode_words(words)
    for w in words:
        lone.known.clear()
        lone.encode_words([w])
        assert shared.known[w] == lone.known[w]


def test_whole_table_round_trip(spark):
    d = read(spark, SF_SMALL, "documents")
    out = spv.decode(spv.encode(d))
    assert out.filter("text <> text_back").count() == 0 and out.count() == d.count()


def test_pieces_are_joined_a_batch_at_a_time():
    """Texts of ids as the plain way gives them, at a fraction of its processor time."""
    import time

    import numpy as np
    import pyarrow as pa
    import sentencepiece
    raw = open(spv.MODEL, "rb").read()
    m = sentencepiece.SentencePieceProcessor(model_proto=raw)
    plain = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else b"" if m.is_control(i)
             else m.id_to_piece(i).replace(spv.MARK, " ").encode() for i in range(m.get_piece_size())]

    def text(ids):
        out = None if ids is None else b"".join([plain[i] for i in ids])
        return out if out is None else (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")

    odd = [i for i in range(m.get_piece_size()) if m.is_byte(i) or m.is_control(i)]
    words = spv.Pieces(raw)
    known = [np.frombuffer(b, np.int32).tolist() for b in words.encode_batch(["  two blanks", " ", "ünï\tcode \U0001F9EA", "plain text " * 40])]
    work = spv.Decoder(raw)
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["ids"])
    whole, broken = [None, [], *known, None], [None, odd, odd[::-1], [odd[-1]], *known]
    for rows in (whole, broken, [], [None], [[]]):
        assert work.column(batch(rows)).to_pylist() == [text(r) for r in rows]
        assert work.column(batch([known[0], *rows]).slice(1)).to_pylist() == [text(r) for r in rows]
    many = batch(known * 3000)

    def least(way):
        spent = []
        for _ in range(3):
            start = time.process_time()
            way()
            spent.append(time.process_time() - start)
        return min(spent)

    assert least(lambda: work.column(many)) < least(lambda: [text(r) for r in many.column("ids").to_pylist()]) / 2
