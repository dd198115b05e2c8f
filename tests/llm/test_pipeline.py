"""The stages against what their operators say, each on its own input."""

import collections
import random

import corpus_pipeline as p
import pytest
from llm_samples import corpus, docs, no_docs  # noqa: F401
from lodestar.llm import jaccard, mixing, suffix_dedup
from lodestar.llm.tables import stored


@pytest.fixture(scope="module")
def stages(spark, docs):
    from pyspark.sql import functions as F
    d, out = docs.withColumn("n_chars", F.length("text").cast("long")), []
    for name, f in p.STAGES:
        d = stored(f(spark, d, None), "stage")
        out.append(d)
    return out


def test_columns_and_order():
    assert [f.__name__ for _, f in p.STAGES] == ["language_id", "near_duplicates",
                                                 "repeated_strings", "mix_sources", "pack"]


def test_language_stage(stages, corpus):
    keep = {d for d, t, *_ in corpus if any(c.isalpha() for c in t or "")}
    assert None in keep
    rows = stages[0].collect()
    assert stages[0].columns == list(p.COLUMNS)
    assert {r.doc_id for r in rows} == keep and len(rows) == len(keep)
    assert {(r.doc_id, r.text, r.lang, r.source) for r in rows} == {x for x in corpus if x[0] in keep}


def _shingles(text):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicate_stage(stages):
    """Brute force: the smallest id of every group of linked texts."""
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in stages[0].collect()))
    sets, left = [_shingles(t) for *_, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if j < i and 100 * len(a & b) >= 80 * len(a | b) > 0:
                lo, hi = sorted((left[i], left[j]))
                left = [lo if x == hi else x for x in left]
    want = [rows[i] for i in sorted(set(left))]
    assert len(want) < len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in stages[1].collect()) == want


def test_language_choice(spark, stages):
    d = stages[0]
    assert p.language_id(spark, d, None, languages=("xx",)).count() == 0
    assert p.language_id(spark, d, None, least=1.01).count() == 0
    assert p.language_id(spark, d, None, languages=("en",)).count() == d.count()


def test_language_stage_rejects_texts_in_another_language_than_labelled(spark):
    """The prediction decides as the stage comes, without parameters."""
    en = "the whether and think through with this them others weather"
    de = "nicht zwischen schwarz und zwanzig jetzt durch ich auch gehen"
    rows = [(i, " ".join(random.Random(i).sample(t.split(), 10)), lang, "s", 60)
            for i, (t, lang) in enumerate([(en, "en"), (de, "de")] * 30)]
    odd = [(100, de, "en", "s", 60), (101, en, "de", "s", 60), (102, de, None, "s", 60)]
    d = spark.createDataFrame(rows + odd, SCHEMA)
    got = {r.doc_id for r in p.language_id(spark, d, None).collect()}
    assert got == {r[0] for r in rows} | {102}
    open_ = {r.doc_id for r in p.language_id(spark, d, None, sure=1.01).collect()}
    assert open_ == got | {100, 101}


def test_repeated_string_stage(stages):
    want = {r.doc_id: r.kept for r in suffix_dedup.remove_repeats(stages[1]).collect()
            if r.n_removed == 0 or r.kept.strip()}
    got = stages[2].collect()
    assert {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_mixing_stage(stages):
    import re
    want = {r.doc_id: r.taken for r in mixing.mix(stages[2]).collect() if r.taken}
    got = collections.Counter()
    for r in stages[3].collect():
        got[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert got == want


def test_packing_stage(stages):
    copies = collections.Counter(r.doc_id for r in stages[3].collect())
    first = collections.Counter(r.doc_id for r in stages[4].where("start = 0").collect())
    assert first == copies


def test_empty_table(spark, no_docs):
    from pyspark.sql import functions as F
    d = no_docs.withColumn("n_chars", F.lit(0).cast("long"))
    for _, f in p.STAGES:
        d = f(spark, d, None)
    assert d.count() == 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows(*rows):
    return [(i, t, None, s, len(t)) for i, t, s in rows]


def test_language_stage_without_labels(spark):
    d = spark.createDataFrame(_rows((1, "some words", "a"), (2, "12 34", "a"), (3, "\u4e2d", "a")), SCHEMA)
    assert sorted(r.doc_id for r in p.language_id(spark, d, None).collect()) == [1, 3]


def test_near_duplicates_of_rows_without_own_ids(spark):
    texts = [" ".join(f"{w}{k}" for w in "abcdefghijklmnopqrst") for k in range(5)]
    d = spark.createDataFrame(_rows((7, texts[0], "a"), (7, texts[1], "a"), (None, texts[2], "b"),
                                    (None, texts[3], "b"), (None, texts[0], "b"), (9, texts[4], "a"),
                                    (8, texts[4], "a"), (None, "", "c")), SCHEMA)
    got = [(r.doc_id, r.text, r.source) for r in p.near_duplicates(spark, d, None).collect()]
    assert sorted(got, key=str) == sorted(
        [(7, texts[0], "a"), (7, texts[1], "a"), (None, texts[2], "b"), (None, texts[3], "b"),
         (8, texts[4], "a"), (None, "", "c")], key=str)


def test_repeated_rows(spark):
    """Of repeated rows one stays as a document, and the mix takes each."""
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text, "a")] * 3 + [(None, text + " more", "a")] * 2 + [(4, "", "b")] * 2
    d = spark.createDataFrame(_rows(*rows), SCHEMA)
    got = sorted((str(r.doc_id), r.text) for r in p.near_duplicates(spark, d, None).collect())
    assert got == [("1", text), ("4", ""), ("4", "")]
    mixed = collections.Counter()
    for r in p.mix_sources(spark, d, None).collect():
        mixed[r.doc_id] += len(r.text.split())
    want = collections.Counter()
    for r in mixing.mix(d).collect():
        want[r.doc_id] += r.taken
    assert mixed == +want and mixed[1] > 90


def test_mixing_of_rows_without_own_ids(spark):
    d = spark.createDataFrame(_rows(*[(1, f"one two w{k}", "a") for k in range(4)],
                                    *[(None, f"three four w{k}", "b") for k in range(4)],
                                    *[(5 + k, f"five six w{k}", None) for k in range(4)]), SCHEMA)
    want = collections.Counter()
    for r in mixing.mix(d).collect():
        want[r.doc_id] += r.taken
    got = collections.Counter()
    for r in p.mix_sources(spark, d, None).collect():
        got[r.doc_id] += len(r.text.split())
    assert got == +want and got[1] and got[None]


def test_near_duplicates_move_texts_once(spark):
    """Rows stand together after the join with those that stay, so their texts
    are not dealt again to tell repeated rows apart."""
    text = " ".join(f"w{k}" for k in range(50))
    rows = _rows((1, text, "a"), (1, text, "a"), (None, text, "b"), (2, text, "a"))
    stage = p.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), None)
    plan = stage._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition("SortMergeJoin")
    assert "Window" in above and "Exchange" not in above and "Exchange" in below
    assert [(r.doc_id, r.text, r.source) for r in stage.collect()] == [(1, text, "a")]
