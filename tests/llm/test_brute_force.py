"""Scores, searches and samples against direct computation, and on inputs that repeat or are dirty."""

import hashlib
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellumgrid.llm import decontaminate, fingerprints, language_id, ngrams, quality, queries, sampling, toxicity
from vellumgrid.llm.common import Scratch

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("text", "words"), [
    ("you idiot!", {"you", "idiot", "idioti"}), ("id!ot", {"idiot"}), ("1d10t", {"diot", "idiot"}), ("$cum!", {"cum", "scum", "cumi", "scumi"}),
        ("M0RоN", {"moron"}), ("idiot, idiot.", {"idiot"}),
    ("in 2024 12!34 $ @ !", {"in", "2024", "12", "34"}), ("idiot$$$", {"idiot", "idiotsss"}), ("ｉｄｉｏｔ", {"idiot"}), ("id​iot", {"idiot"}), ("", set()),
])
def test_folding(text, words):
    assert set(toxicity.fold(text).split()) == words


def test_a_mark_after_a_word_makes_no_difference():
    lexicon = toxicity.Lexicon({" idiot ": 3.0})
    assert lexicon.totals(["you idiot", "you idiot!", "you idiot!!!", "idiot!you", "you 1d!ot!"])[:, 0].tolist() == [3, 3, 3, 0, 3]


def test_automaton_equals_plain_search():
    r = np.random.default_rng(11)
    word = lambda: "".join(r.choice(list("abc"), int(r.integers(1, 4))))
    weights = {f" {word()} ": float(r.integers(1, 9)) for _ in range(20)} | {f" {word()}": float(r.integers(1, 9)) for _ in range(10)}
    lexicon = toxicity.Lexicon(weights, tuple({f"{word()} {word()}" for _ in range(15)}))
    texts = [" ".join(word() + str(r.choice(["", "", "!", "1"])) for _ in range(int(r.integers(0, 40)))) for _ in range(200)]
    found = lexicon.totals(texts)
    for text, (total, words) in zip(texts, found):
        folded = toxicity.fold(text)
        at = lambda x: [i for i in range(len(folded)) if folded.startswith(x, i)]
        free = [(i, i + len(p) + 1) for p in lexicon.exceptions for i in at(f" {p} ")]
        want = sum(w for t, w in weights.items() for i in at(t) if not any(a <= i and i + len(t) - 1 <= b for a, b in free))
        assert total == want and words == len(toxicity.words_in(folded))


def test_mean_scores_are_sums_over_all_grams(monkeypatch):
    r = np.random.default_rng(2)
    texts = pa.array(["", "Ab", "a", "É" * 30, "the quick brown fox " * 20, None, "x"]).fill_null("")
    weights = r.normal(size=(ngrams.SPACE + 1, 3)).astype(np.float32)
    weights[-1] = 0
    want = []
    for x in texts.to_pylist():
        data = ngrams.fold(np.frombuffer(x.encode(), np.uint8)) if x else np.zeros(0, np.uint8)
        total = np.zeros(3)
        for order in ngrams.ORDERS:
            for i in range(len(data) - order + 1):
                packed = sum(int(b) << (8 * k) for k, b in enumerate(data[i : i + order]))
                total += weights[((packed * int(ngrams._MULTIPLY[order % 3]) + order) & 0xFFFFFFFF) >> 16]
        want.append(total / max(1, len(data)))
    assert ngrams.mean_scores(texts, weights) == pytest.approx(np.array(want), abs=1e-4)
    assert ngrams._mean_scores(texts, weights, cells=21) == pytest.approx(np.array(want), abs=1e-4)


def test_votes_by_a_loop():
    r = np.random.default_rng(3)
    langs = ["en", "de", "nl", "fr", "es", "it", "xx", "yy"]
    rows = [("".join(r.choice(list("abcdefgh"[k : k + 4] + " "), 60)), lang) for k, lang in enumerate(langs) for _ in range(12)]
    model = language_id.fit(rows)
    texts = pa.array(["".join(r.choice(list("abcdefghijk "), 40)) for _ in range(300)])
    got = list(zip(*model.predict(texts)))
    raw = ngrams.mean_scores(texts, model.weights)
    p = np.stack([ngrams.logistic(a * raw[:, i] + b) for i, (a, b) in enumerate(model.curves)], axis=1)
    n = len(model.families)
    assert n == 3
    for i, (lang, score) in enumerate(got):
        k = int(p[i, :n].argmax())
        own = model.languages[model.families[k]]
        votes, chance = dict.fromkeys(own, 0), dict.fromkeys(own, 1.0)
        for a, b in combinations(own, 2):
            q = p[i, n + model.pairs.index((a, b))]
            votes[a if q >= 0.5 else b] += 1
            chance[a], chance[b] = min(chance[a], q), min(chance[b], 1 - q)
        top = max(own, key=lambda x: (votes[x], chance[x], x))
        assert (lang, score) == (top, pytest.approx(p[i, k] / p[i, :n].sum() * chance[top]))


def test_quality_scores_by_hand(spark):
    r = np.random.default_rng(4)
    rows = [("".join(r.choice(list("abcd \n" if i % 2 else "WXYZ 12"), 80)), f"s{i % 3}", "en", i % 2) for i in range(160)]
    model = quality.fit(rows, [x[:3] for x in rows[:60]])
    docs = spark.createDataFrame([(i, *x[:3]) for i, x in enumerate(rows)], "doc_id long, text string, source string, lang string")
    got = {x.doc_id: x for x in quality.score(docs, model, [F.col("doc_id")]).collect()}
    curve = lambda x: 1 / (1 + np.exp(-x))
    for i, (text, source, lang, label) in enumerate(rows):
        c = model.curves[0][0] * ngrams.mean_scores(pa.array([text]), model.content)[0, 0] + model.curves[0][1]
        numbers = quality.layout(pa.array([text]))[0]
        total = model.meta.weights[-1]
        for k, cuts in enumerate(model.meta.cuts):
            total += model.meta.weights[k * (quality.BINS + 1) + sum(x < numbers[k] for x in cuts)]
        first = len(model.meta.cuts) * (quality.BINS + 1)
        total += model.meta.weights[first + quality._slot(source, "source")] + model.meta.weights[first + quality._HASHED + quality._slot(lang, "lang")]
        m = model.curves[1][0] * total + model.curves[1][1]
        assert (got[i].content_score, got[i].meta_score, got[i].score) == pytest.approx((curve(c), curve(m),
            curve(model.mix[0] + model.mix[1] * c + model.mix[2] * m)), abs=1e-6)


def test_samples_are_bounded_by_rows(spark):
    """One id with 100,000 equal rows and another with as many different ones."""
    same = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    other = spark.range(100_000).select(F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    few = spark.range(3, 303).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), F.col("id").cast("string")).alias("text"))
    docs = same.unionByName(other).unionByName(few).withColumns({"source": F.lit("s"),
        "lang": F.when(F.col("doc_id") < 3, F.col("doc_id").cast("string")).otherwise("en")})
    labels = spark.range(303).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"), (F.col("id") % 2).alias("quality"))
    rows = toxicity.sample(docs, labels, most=500)
    assert sum(x == 0 for _, x in rows) == 500 and sum(x == 1 for _, x in rows) == 151
    labelled, pool = quality.sample(docs, labels.where("doc_id <> 2"), most=100, pool=200)
    assert len(pool) == 200 and len(labelled) == 200 and {x[0].split()[0] for x in pool} == {"text"}
    rows = language_id.sample(docs, "doc_id", "text", "lang", most=50)
    assert {x: sum(y == x for _, y in rows) for x in ("1", "2", "en")} == {"1": 1, "2": 50, "en": 50}
    assert rows == language_id.sample(docs.repartition(7), "doc_id", "text", "lang", most=50)


def test_labels_that_conflict_are_ignored(spark):
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (2, 0), (3, None), (None, 1), (4, 7), (5, 1), (5, None)], "doc_id long, toxic int")
    assert {(x.id, x.label) for x in sampling.agreed(labels, "doc_id", "toxic").collect()} == {(1, 0), (5, 1)}


def test_dirty_language_columns_have_a_bounded_model(spark):
    rows = [(i, f"{'the cat and the dog' if i % 3 else 'der hund und die katze'} {i}", ("en" if i % 3 else "de") if i < 600 else f"dirt{i}") for i in range(1100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.sample(docs, "doc_id", "text", "lang")
    assert len({x for _, x in got}) == language_id.LANGUAGES
    model = language_id.fit(got)
    assert model.weights.shape[1] <= language_id.MACHINES and {"en", "de"} <= {x for own in model.languages.values() for x in own}
    assert language_id.learnable([f"a{i}" for i in range(100)]) == [f"a{i}" for i in range(23)]


def test_contamination_by_alignment_of_everything(spark):
    r = np.random.default_rng(7)
    letters = list("abcdefg ")
    items = [(i, "".join(r.choice(letters, 50))) for i in range(5)] + [(7, "a" * 40), (8, "short"), (9, None)]
    texts = [(None, items[0][1]), (1, None), (2, ""), (3, "x" * 30 + items[1][1].upper() + "y" * 30), (3, "a" * 500)]
    for i in range(30):
        x = list(items[i % 5][1])
        for _ in range(i % 8):
            at = int(r.integers(0, len(x)))
            x[at : at + 1] = ["z"] * int(r.integers(0, 3))
        texts.append((10 + i, "".join(r.choice(letters, 30)) + "".join(x) + "".join(r.choice(letters, 30))))
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench).collect()
    index = decontaminate.build(items)

    def edits(item, text):
        row = [0] * (len(text) + 1)
        for c in item:
            new = [row[0] + 1]
            for j, t in enumerate(text):
                new.append(min(row[j] + (c != t), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row)

    want = sorted(repr((d, int(i), n)) for d, t in texts for i, c, k in zip(index.ids, index.codes,
        index.edits) if (n := edits(c.tolist(), decontaminate.folded(t or "")[0].tolist())) <= k)
    assert sorted(repr((x.doc_id, x.item_id, x.edits)) for x in got) == want and len(want) > 10
    of = {(x.doc_id, x.item_id): x for x in got}
    for (d, i), x in of.items():  # the place alone has that many edits
        for t in [t for n, t in texts if n == d and t]:
            if x.end <= len(t):
                own = index.codes[list(index.ids).index(i)].tolist()
                part = decontaminate.folded(t[x.start : x.end])[0].tolist()
                row = list(range(len(part) + 1))
                for c in own:
                    new = [row[0] + 1]
                    for j, p in enumerate(part):
                        new.append(min(row[j] + (c != p), row[j + 1] + 1, new[j] + 1))
                    row = new
                if d != 3:
                    assert row[-1] <= x.edits + 2
    small = [t or "" for _, t in texts]
    assert decontaminate.matches(index, small, expanded=50) == decontaminate.matches(index, small)
    assert sorted(repr(tuple(x)) for x in decontaminate.contamination(docs, bench, block=60).collect()) == sorted(repr(tuple(x)) for x in got)


def _likeness(a, b):
    if "-" in (a, b):
        return float(a == b)
    same = np.mean([a[i : i + 2] == b[i : i + 2] for i in range(0, len(a), 2)])
    return max(0.0, (same - 2.0**-8) / (1 - 2.0**-8))


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_edited_fingerprints_of_odd_rows(spark, partitions):
    """All columns from the fingerprints of the texts alone, over ranges with none, one and several rows."""
    rows = [(None, "null id " * 9), (None, "another null id " * 9), (1, None), (2, ""), (3, "a b c"), (3, "a b c"), (3, "other text of three"),
        (4, "w " * 30_000), (7, "é日本😀 " * 7), (9, " \n\t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit("x"), "id": F.lit(0), "h": F.lit(1)})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fingerprints.edited_fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(rows)
    prints = lambda texts: fingerprints.printed(fingerprints.signatures(pa.array(texts, pa.string())))
    alone = {(d, t or ""): prints([t or ""])[0] for d, t in rows}
    # each row's text before it is one of the texts of its own id or of the id before
    ids = [None, 1, 2, 3, 4, 7, 9]
    unmatched = [(d, t or "") for d, t in rows]
    for x in got:
        near = [t or "" for d, t in rows if d in (x.doc_id, ids[ids.index(x.doc_id) - 1])]
        found = False
        for d, t in unmatched:
            if d != x.doc_id or len(t) != x.n_chars or alone[d, t] != x.fingerprint:
                continue
            for y in near:
                edited = t[: len(t) - len(t) // 3] + y[: len(t) // 3]
                if hashlib.sha256(edited.encode()).hexdigest() == x.edited_sha256:
                    own = prints([edited])[0]
                    found |= x.edited_fingerprint == own and x.near_edited == pytest.approx(_likeness(x.fingerprint,
                        own)) and any(x.near_next == pytest.approx(_likeness(x.fingerprint, prints([z])[0])) for z in near)
        assert found, x
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0


def test_fingerprints_of_the_whole_table(spark):
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries.op2_fingerprints(spark, MIDDLE).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        g, before = got[r.doc_id], got[rows[i - 1].doc_id]
        assert g.near_next == pytest.approx(_likeness(g.fingerprint, before.fingerprint))
        assert g.near_edited == pytest.approx(_likeness(g.fingerprint, g.edited_fingerprint))
        edited = r.text[: len(r.text) - len(r.text) // 3] + rows[i - 1].text[: len(r.text) // 3]
        assert g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if i % 50 == 0:
            assert g.edited_fingerprint == fingerprints.printed(fingerprints.signatures(pa.array([edited])))[0]


def test_bands_find_the_links(spark):
    """Recall of near_pairs against comparing all sets: of the links of 0.8 or more, those whose ends it connects."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    words = {r.doc_id: [w for w in re.split("[ \t-\r]+", r.text.lower()) if w] for r in rows}
    sets = {d: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for d, w in words.items() if w}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = {d: d for d in sets}
    scratch = Scratch(spark, "test")
    for g in fingerprints.near_pairs(docs, scratch=scratch).collect():
        a, b = root[g.id], root[g.like]
        root = {k: a if v == b else v for k, v in root.items()}
    assert links and sum(root[a] == root[b] for a, b in links) >= 0.9 * len(links)
