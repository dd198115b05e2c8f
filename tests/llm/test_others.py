"""The other operators against brute force, exact round trips or accuracy."""

import collections
import hashlib
import math
import random
import zlib

import pytest
from conftest import SF_MID, SF_SMALL
from llm_samples import corpus, docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from lodestar.llm import (fingerprints, html_text, language, mixing, packing, queries, sharding,
                          topk)


def test_html_cases():
    m = html_text.main_text
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header>
      <nav><ul><li><a href=1>menu</a></ul></nav><div class="cookie-notice">We use cookies a lot</div>
      <main><article><h1>Big &amp; small</h1><p>One <b>bold</b>\n  text<p>Two<br>lines &copy; 5
      <form><p>name</form><div class=ad>Buy now</div></article>
      <section id="comments"><p>A reader comment of some length</p></section></main>
      <aside>more</aside><script>var a="</p><p>no";</script><!-- <p>no</p> --><footer>f</footer>"""
    assert m(page) == "Big & small\nOne bold text\nTwo lines © 5"
    assert [m(x) for x in (None, "", "  ", "<p></p>", "<!-- x", "<p", "a&lt;b", "<div><p>Hello")] == \
        ["", "", "", "", "", "", "a<b", "Hello"]
    # a class alone never takes out most of the page; deep nesting is no trouble
    assert m("<body><div class='sidebar'><p>All of the text is here</div>") == "All of the text is here"
    assert m("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert m("<article><p>" + "word " * 50_000 + "</article>").count("word") == 50_000


def _paragraphs(n, chars):
    return "".join(f"<p>{'word ' * (chars // 5)}</p>" for _ in range(n))


def test_html_articles_of_many_sections():
    m = html_text.main_text
    sections = (f"<h1>Title</h1><section>{_paragraphs(5, 300)}</section><h2>Between</h2>"
                f"<section>{_paragraphs(4, 300)}</section>")
    for page in (f"<article>{sections}</article>", f"<div>{sections}</div>", sections,
                 f"<div class=page><div>{sections}</div></div><div><a href=1>More of the site</a></div>",
                 f"<main>{sections}</main>", sections.replace("section>", "div>")):
        got = m(f"<body>{page}</body>").split("\n")
        assert got[0] == "Title" and got[6] == "Between" and len(got) == 11, page
    # a list that outweighs the paragraphs around it
    items = "".join(f"<li>{'item ' * 80}</li>" for _ in range(8))
    for tag in ("article", "div"):
        got = m(f"<{tag}><h1>T</h1>{_paragraphs(2, 300)}<ul>{items}</ul>{_paragraphs(2, 300)}"
                f"<p>The end.</p></{tag}><div><a href=1>x y</a> <a href=2>z</a></div>").split("\n")
        assert (got[0], got[-1], len(got)) == ("T", "The end.", 14)
    # links between sections and text beside the article are no part of it
    assert m(f"<div><div>{_paragraphs(5, 300)}</div><div><a href=1>read this too</a></div>"
             f"<div>{_paragraphs(4, 300)}</div></div><p>Copyright</p>").count("\n") == 8
    beside = f"<article>{_paragraphs(5, 300)}</article><div><div>{_paragraphs(2, 200)}</div></div>"
    assert m(beside).count("\n") == 4
    assert m(f"<h1>T</h1><div>{_paragraphs(3, 300)}</div>").startswith("T\nword")


def test_html_marked_parts_go_at_any_length():
    m = html_text.main_text
    said = "".join(f"<div class=item><p>{'said ' * 20}</p></div>" for _ in range(20))
    for mark in ("id=comments", "class='post-comments'", "class=sidebar", "class='cookie notice'",
                 "class=related-posts"):
        for article in (f"<article>{_paragraphs(1, 500)}</article>", f"<div>{_paragraphs(1, 500)}</div>"):
            got = m(f"<body>{article}<div {mark}>{said}</div>")
            assert "said" not in got and got.count("word") == 100, mark
    # what is around the article, or the only text, is not taken out by its class
    for page in (f"<div class='layout sidebar'><main>{_paragraphs(2, 300)}</main></div><p>Copyright</p>",
                 f"<div class='has-sidebar'>{_paragraphs(2, 300)}</div><div class=sidebar>{said}</div>",
                 f"<h1>T</h1><a href=1>Home</a><div class=widget>{_paragraphs(2, 300)}</div>",
                 f"<div class=widget>{_paragraphs(2, 300)}<div class=comments>said</div></div>"):
        got = m(page)
        assert "said" not in got and "Copyright" not in got and got.count("word") == 120, page
    assert m("<div class=sidebar>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_html_page_inside_a_form():
    m = html_text.main_text
    fields = ("<label>Search</label><input name=q><button>Go</button><select><option>one</select>"
              "<textarea>typed</textarea>")
    article = f"<h1>T</h1>{_paragraphs(3, 300)}"
    want = m(article)
    assert want.count("word") == 180 and want.startswith("T\n")
    for body in (article, f"<article>{article}</article>", f"<main>{article}</main>",
                 article.replace("h1", "h2"), f"<div>{article}</div>"):
        for a, b in (("<form method=post>", "</form>"), ("<div role=form>", "</div>"),
                     ("<form><fieldset><legend>Name</legend>", "</fieldset></form>"),
                     ("<object>", "</object>"), ("<dialog open>", "</dialog>")):
            assert m(f"<body>{a}{fields if 'f' in a else ''}{body}{b}</body>") == want, (a, body)
    assert m(f"<form>{fields}{article}<div class=comments>{_paragraphs(9, 300)}</div></form>"
             "<div>Copyright</div>") == want
    # without paragraphs and headings; forms that are only forms; a notice longer than the article
    assert m(f"<form><div>{'word ' * 50}</div>{fields}</form>").count("word") == 50
    assert m(f"<form>{fields}</form>") == ""
    assert m(f"<div>{article}</div><form><h3>Leave a reply</h3><p>Your name <input></p></form>") == want
    assert m(f"{article}<dialog><h1>Notice</h1>{_paragraphs(9, 300)}</dialog>") == want


def test_html_pages(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>x"), (1, None, None)],
                               "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert sorted(map(str, html_text.extract(df).collect())) == sorted(map(str, [
        html_text.extract(df.limit(1)).first(), html_text.extract(df.limit(1)).first(),
        html_text.extract(df.where("page_id is null")).first()]))
    assert html_text.extract(df.where("false")).count() == 0
    got = {r.page_id: r for r in queries.op2_html(spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        import html
        import re
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split())
                 for x in re.split("</?(?:p|h1)>", body)]
        assert got[r.page_id].text == "\n".join(x for x in parts if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_ids_are_the_tokenizers(tokenizer):
    import public_tokenizers as P
    rng = random.Random(5)
    letters = " \n\t'srtlvemdAB1!. é中²́\U0001f600 "
    texts = ["", "it's  a  \n\n test", "'s 't 'q ''s", "x re'll 've", "trail  ", "don'T we'Re"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    tok = packing.WordTokenizer(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    ids, ends = tok.encode(texts)
    for t, a, b in zip(texts, [0, *ends[:-1]], ends):
        assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_packing(docs, no_docs, corpus, tokenizer):
    import numpy as np
    special = docs.limit(1).select(F.lit(10 ** 6).cast("long").alias("doc_id"),
                                   F.lit("a <|endoftext|> b").alias("text"))
    rows = queries.packed(docs.select("doc_id", "text").union(special)).collect()
    texts = {d: t for d, t, *_ in corpus} | {10 ** 6: "a <|endoftext|> b"}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for found, whole in [(v, v[0][2]) for v in pieces.values()] + [(v, None) for v in sequences.values()]:
        at = 0
        for start, length, *_ in sorted(found):
            assert start == at and length > 0
            at += length
        assert at == whole if whole else at <= 2048
    assert set(pieces) == set(texts)
    assert queries.packed(no_docs).count() == 0


def test_hilbert_curve_visits_neighbours():
    import itertools

    import numpy as np
    points = np.array(list(itertools.product(range(8), repeat=3)))
    keys = packing.hilbert_key(points, bits=3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_fingerprints(docs, no_docs, corpus):
    order = sorted(corpus, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(docs).collect()}
    assert len(got) == len(order)
    by_text = collections.defaultdict(set)
    for i, (d, t, *_) in enumerate(order):
        t, x = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        edit = t[:len(t) - k] + x[:k]
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert (r.fingerprint == r.edited_fingerprint) == (edit == t)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) >= (edit == t)
        by_text[t].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len(set().union(*by_text.values())) == len(by_text)
    assert fingerprints.fingerprint_edits(no_docs).count() == 0
    one = fingerprints.fingerprint_edits(docs.where("doc_id = 4")).first()
    assert one.doc_id == 4


def test_differing_branches_locate_edits(spark):
    df = spark.createDataFrame([("a. b\nc\n\nd\ne", "a. b\nc\n\nd\nX"), ("s\nt", "s\nt")],
                               "x string, y string")
    tree = [fingerprints.paragraph_nodes(fingerprints.merkle_leaves(F.col(c))) for c in "xy"]
    got = [[tuple(p) for p in r[0]] for r in
           df.select(fingerprints.differing_paragraphs(*tree)).collect()]
    assert got == [[(1, 1)], []]


def reshared(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        whole = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / whole > 2 * sizes[s]]
        for s in over or list(free):
            target[s] = 2.0 * sizes[s] if over else left * weight[s] / whole
        left -= sum(target[s] for s in over)
        free -= set(over or free)
    return target


def test_mixing(docs, no_docs, corpus):
    rows = mixing.mix(docs, keep=("label",)).collect()
    assert len(rows) == len(corpus)
    source = {d: s for d, _, _, s in corpus}
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    target = reshared(sizes)
    assert {source[r.doc_id]: round(r.target, 6) for r in rows} == \
        {s: round(t, 6) for s, t in target.items()}
    assert {source[r.doc_id]: r.source_size for r in rows} == sizes
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in sizes)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == \
        sorted(map(tuple, mixing.mix(docs.repartition(3), key_buckets=2).collect()), key=str)
    assert mixing.mix(no_docs).count() == 0


def test_mixing_levels(spark):
    rng = random.Random(2)
    for _ in range(6):
        sizes = {f"s{i}": rng.randint(0, 10 ** rng.randint(1, 6)) for i in range(rng.randint(1, 12))}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        want = reshared(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_language_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op7_language(spark, SF_MID).collect()}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    held = [(rows[d.doc_id], d) for d in docs if rows[d.doc_id].held_out]
    assert all(rows[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0) for d in docs)
    assert sum(r.lang_pred == d.lang for r, d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_without_letters(docs, no_docs):
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all((got[d].lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
               for d, t in texts.items())
    assert language.identify(no_docs).count() == 0
    untrained = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in untrained.collect()} == {"und"}


def test_top_k(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, list(rows[0][1])) for i in range(30)]            # ties
    rows += [(40, list(rows[1][1])), (2000, None), (2020, [1.0] * 7 + [None]), (None, [1.0] * 8),
             (2040, [1.0] * 7 + [float("nan")]), (2060, [float("inf")] * 8), (2080, [1.0] * 3),
             (2100, [0.5, 2.0, 1.0]), (2120, [3e5, 2e8, 1e7])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>").withColumn("n", F.lit(1))
    good = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v
            and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in good:
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in good
                           if c != q and len(w) == len(v))
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(found[:5])]
    want_ids = collections.Counter(q for q, *_ in want)
    for shard, block, fan in ((16384, 4096, 16), (40, 7, 2)):
        got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 20 = 0"), 5, shard_rows=shard,
                                           block_rows=block, fan_in=fan).collect()))
        assert collections.Counter(q for q, *_ in got) == want_ids
        assert sorted(set(got)) == sorted(set(want))
    assert topk.top_k(df.where("false"), df.where("false")).count() == 0


def test_sharding(docs, no_docs, corpus):
    rows = sharding.shard(docs).collect()
    texts = {d: t or "" for d, t, *_ in corpus}
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(rows) == len(corpus)
    for s in range(16):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    for r in rows:
        b = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 1, zlib.crc32(b), "rows", None)
    assert sharding.shard(no_docs).count() == 0


def test_sharding_keeps_groups_together(spark):
    rows = [(i, f"text {i // 4}") for i in range(800)] + [(1000 + i, f"lone {i}") for i in range(4000)] \
        + [(9000 + i, "hot") for i in range(2400)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    where = collections.defaultdict(set)
    for r in got:
        where["hot" if r.doc_id >= 9000 else r.doc_id // 4 if r.doc_id < 800 else r.doc_id].add(r.shard)
    assert sum(len(v) > 1 for k, v in where.items() if k != "hot" and k < 200) <= 30
    assert len(where["hot"]) < 16
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1


@pytest.mark.parametrize("copies, lone", [(2, 0), (2, 450), (5, 0)])
def test_sharding_of_a_table_of_copies(spark, copies, lone):
    rows = [(i, f"text {i // copies}") for i in range(4000)] + \
        [(9000 + i, f"lone {i}") for i in range(lone)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == sorted(x for x, _ in rows)
    counts = collections.Counter(r.shard for r in got)
    assert len(counts) == 16 and max(counts.values()) - min(counts.values()) <= 1
    where = collections.defaultdict(set)
    for r in got:
        if r.doc_id < 9000:
            where[r.doc_id // copies].add(r.shard)
    # a cut between two shards parts one group at most
    assert sum(len(v) - 1 for v in where.values()) <= 15
