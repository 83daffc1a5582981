"""Operators against plain Python versions, on real and awkward documents."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from oreline.llm import exact, licenses, lines, links, near, ngrams, repeats, urls

from . import brute
from .fixtures import clashing, frame, made, sample


@pytest.fixture(scope="module")
def docs(spark):
    return sample(spark) + made()


@pytest.fixture(scope="module")
def df(spark, docs):
    return frame(spark, docs).cache()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_license_base(df, docs):
    got = {r[0]: r[1:] for r in rows(licenses.scan_licenses(df), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")}
    assert got == brute.licenses(docs, licenses.BASE)


def test_license_labels(spark):
    text = "This is under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0. SPDX-License-Identifier: Apache-2.0"
    got = licenses.scan_licenses(frame(spark, [(1, text), (2, "nothing here"), (3, None)])).orderBy("doc_id").collect()
    assert got[0].labels == "apache-2.0,cc-by,cc-by-nc-4.0,gpl,gpl-3.0" and got[0].base_labels == "cc-by,gpl"
    assert 0.5 < got[0].score <= 1 and got[1].labels == "" and got[1].score == got[2].score == 0


def test_license_suppression(spark):
    one = frame(spark, [(1, "licensed under the Apache License, Version 2.0")])
    found = licenses.detections(one, "doc_id", "text").collect()
    kept = {(r.label, r.start, r.stop) for r in found if r.kept}
    assert kept == {("apache-2.0", 0, 8)} and any(r.label == "apache" and not r.kept for r in found)


def test_rules_leave_a_trace():
    import re

    for _, _, label, keyword, needs, pattern, _ in licenses.rules():
        plain = re.sub(r"\(\?:([^()|]*(?:\([^()]*\))?[^()|]*)(\|[^()]*)?\)\??", r"\1", pattern)
        plain = re.sub(r"\(\?:([^()|]*)(\|[^()]*)?\)\??", r"\1", plain).replace("[cs]", "c").replace(" ?", " ").replace("d?", "d")
        assert re.search(licenses.TRACE, plain), pattern
        assert re.fullmatch("[a-z0-9]+", keyword) and pattern.startswith(keyword) and needs in plain, pattern


@pytest.mark.parametrize("few", [False, True])
def test_near(spark, df, docs, few):
    use, frame_ = (docs, df) if not few else (made(3), frame(spark, made(3)))
    got = {r[0]: r[1:] for r in rows(near.near_groups(clashing(frame_)), "doc_id", "n_shingles", "component_id", "kept")}
    assert got == brute.near(use)


def test_near_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 7)
    base = " ".join(f"w{i}" for i in range(200)).split()
    texts = [base[:k] + [f"x{k}"] + base[k + 1 :] for k in range(60)] + [base] * 50 + [base[:150] + [f"y{k}{j}" for j in range(50)] for k in range(20)]
    docs = [(i * 7 % 1009, " ".join(t)) for i, t in enumerate(texts)]
    got = {r[0]: r[1:] for r in rows(near.near_groups(frame(spark, docs)), "doc_id", "n_shingles", "component_id", "kept")}
    assert got == brute.near(docs)


def test_near_repeated_and_missing_ids(spark):
    docs = frame(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A b c d e f"), (7, None), (7, ""), (9, "q")])
    got = rows(near.near_groups(docs), "doc_id", "component_id", "kept")
    assert got == sorted([(5, 5, True), (5, 5, False), (None, 5, False), (7, 7, True), (7, 7, True), (9, 9, True)], key=str)
    kept = near.drop_near(docs)
    assert kept.columns == docs.columns and rows(kept, "doc_id") == [(5,), (7,), (7,), (9,)]


def test_repeats(df, docs):
    got = rows(repeats.remove_repeats(clashing(df)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute.repeats(docs)


@pytest.mark.parametrize(("window", "minimiser"), [(3, 1), (8, 8), (10, 4)])
def test_repeats_small_windows(spark, monkeypatch, window, minimiser):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 200)
    docs = made(5) + [(1, "dup dup dup dup " * 9), (1, "dup dup dup dup " * 9), (None, "p q r")]
    got = rows(repeats.remove_repeats(frame(spark, docs), window=window, minimiser=minimiser), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute.repeats(docs, window)


def test_repeats_hot_minimiser(spark, monkeypatch):
    """A minimiser whose strings all differ is not counted in one task."""
    passage = " ".join(f"p{i}" for i in range(40))
    docs = made(6) + [(k, " ".join([f"a{k}x{i}" for i in range(20)] + [passage] + [f"b{k}x{i}" for i in range(20)])) for k in range(80)]
    dealt, count = [], repeats._count
    monkeypatch.setattr(repeats, "HOT_BYTES", 4000)
    monkeypatch.setattr(repeats, "_count", lambda strings, window: dealt.append(strings) or count(strings, window))
    got = rows(repeats.remove_repeats(frame(spark, docs)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute.repeats(docs)
    sizes = dealt[0].groupBy("bucket").agg(F.sum(F.octet_length("packed")).alias("bytes"))
    assert sizes.agg(F.max("bytes")).first()[0] <= 4000


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff(df, docs, order, monkeypatch):
    from oreline.llm import packed

    monkeypatch.setattr(packed, "RANGE_KEYS", 5000)
    got = {r.doc_id: r for r in ngrams.backoff_scores(clashing(df), order=order).collect()}
    for doc, n, score in brute.backoff(docs, order):
        assert got[doc].n_words == n and math.isclose(got[doc].log_score, score, rel_tol=1e-9, abs_tol=1e-9)
        assert (got[doc].mean_log_score is None) == (n == 0)


def test_trigram_query(spark):
    """The registered trigram query scores as its SQL does."""
    from oreline.llm.registry import ORACLE, QUERIES

    root = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op3_lm_scoring_trigrams"](spark, root).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{root}/documents.parquet'")
    want = con.execute(ORACLE["op3_lm_scoring_trigrams"]).fetchall()
    assert len(got) == len(want) > 0
    for doc, n, score, mean in want:
        assert got[doc].n_words == n and math.isclose(got[doc].log_score, score, abs_tol=2e-4)
        assert (got[doc].mean_log_score is None) if mean is None else math.isclose(got[doc].mean_log_score, mean, abs_tol=2e-6)


def test_ngram_counts(spark):
    got = ngrams.ngram_counts(frame(spark, [(1, "a b a b"), (2, "B a"), (3, None)]), order=2)
    assert rows(got.groupBy("n", "count").agg(F.count(F.lit(1)).alias("k")), "n", "count", "k") == [(1, 3, 2), (2, 2, 2)]


def test_exact(df, docs):
    got = rows(exact.exact_groups(clashing(df), digest_all=True), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact(docs)


def test_exact_ties(spark):
    docs = [(1, "t"), (2, "t"), (2, "t"), (3, "u"), (None, "t"), (None, "v"), (None, "v"), (4, None), (5, "")]
    got = rows(exact.exact_groups(frame(spark, docs), digest_all=True), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact(docs)
    kept = exact.drop_exact(clashing(frame(spark, docs)))
    assert rows(kept, "doc_id", "text") == sorted([(2, "t"), (3, "u"), (None, "v"), (5, "")], key=str)


def test_exact_full_filter(spark, monkeypatch):
    """A filter that lets everything through changes nothing."""
    monkeypatch.setattr(exact, "test_bit", lambda *_: F.lit(True))
    docs = made(2)
    got = rows(exact.exact_groups(frame(spark, docs)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact(docs)


def test_lines(spark):
    docs = made(4) + [(d, t[:600]) for d, t in sample(spark, 25)]
    got = lines.line_classes(clashing(frame(spark, docs))).collect()
    want = brute.lines(docs)
    firsts = {r.class_id: (r.doc_id, r.line_no) for r in got if r.kept}
    assert {(r.doc_id, r.line_no): (firsts[r.class_id], r.near) for r in got} == want


def test_line_variants(spark, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 9)
    base = "a line that is long enough to vary in many places of its text"
    docs = [(k, base[:k] + "#" + base[k + 1 :] + "\n" + base[:k] + base[k + 1 :] + "\nother " + "z" * k) for k in range(40)]
    got = lines.line_classes(frame(spark, docs)).collect()
    want = brute.lines(docs)
    firsts = {r.class_id: (r.doc_id, r.line_no) for r in got if r.kept}
    assert {(r.doc_id, r.line_no): (firsts[r.class_id], r.near) for r in got} == want


def test_line_limit_grows(spark):
    """One replaced word in a long line is a near line, as in a plain comparison of all pairs under the same limit."""
    import random

    rng = random.Random(3)
    say = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n)]
    docs = []
    for k in range(60):
        words = say(rng.randint(3, 60))
        other = list(words)
        for _ in range(1 + k % 2):
            other[rng.randrange(len(words))] = say(1)[0]
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = {r.doc_id: r.class_id for r in lines.line_classes(frame(spark, docs), threshold=None).collect()}
    linked = {k for k in range(60) if got[2 * k] == got[2 * k + 1]}
    limit = {k: lines.edit_limit(max(len(docs[2 * k][1]), len(docs[2 * k + 1][1])), None, 0.8) for k in range(60)}
    apart = {k: brute.edit(docs[2 * k][1], docs[2 * k + 1][1]) for k in range(60)}
    assert linked == {k for k in range(60) if apart[k] <= limit[k]}
    assert sum(2 < apart[k] for k in linked) > 15 and len(set(got.values())) == 120 - len(linked)


def test_blocks_of_very_large_buckets(spark):
    """Numbers of block pairs do not overflow where a bucket has tens of millions of members."""
    rest = spark.createDataFrame([(1, 40_000_000, i, i) for i in range(3)], "bucket bigint, n bigint, id bigint, component bigint")
    blocks = -(-40_000_000 // links.BLOCK)
    got = links._blocks(rest).agg(F.min("k2"), F.max("k2"), F.count(F.lit(1))).first()
    assert 0 <= got[0] and 2**31 < got[1] < blocks * blocks and got[2] == 3 * blocks


def test_drop_repeated_lines(spark):
    docs = frame(spark, [(1, "first line here\n\nsecond line here"), (2, "x\nfirst line here\n  first line here \nfirst lime here\ny"), (3, None), (4, "")])
    got = rows(lines.drop_repeated_lines(docs), "doc_id", "text")
    assert got == [(1, "first line here\n\nsecond line here"), (2, "x\ny"), (3, None), (4, "")]


def test_urls(spark):
    urls_ = ["http://A.Example.ORG/en/123?x", "https://example.org/es/", "ftp://xexample.org/es/q", "http://m.shop.com/de/1", "http://shop.com/fr", "http://shop.com/fr/",
             "no scheme", None, "", "http://", "://org/x", "http://www.spam-farm.net#t", "http://org", "http://ok.net/?u=http://bad.com/de/"]
    pages = spark.createDataFrame(list(enumerate(urls_)) + [(1, urls_[1])], "page_id bigint, url string")
    got = rows(urls.judge_urls(clashing(pages), urls.RULES, urls.junk_hosts(pages)), "page_id", "host", "path", "rule", "verdict", "listed")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.execute(f"SELECT page_id, host, path, rule, verdict, listed FROM ({urls.OP7_SQL})").fetchall()
    want = {(w[0], *w[1:]) for w in want}
    assert set(got) == want and len(got) == len(urls_) + 1


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 1)  # so that false positives are many and levels too
    universe = spark.range(20_000).selectExpr("concat('k', id) AS key")
    listed = universe.where("crc32(key) % 3 = 0").union(spark.createDataFrame([("outside",), (None,)], "key string"))
    cascade = urls.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    assert universe.where(cascade.contains(F.col("key")) != (F.expr("crc32(key) % 3 = 0"))).isEmpty()


def test_cascade_parts(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i}.net/") for i in range(300)], "page_id bigint, url string")
    listed = pages.where("page_id % 7 = 0").selectExpr("concat('h', page_id, '.net') AS key")
    monkeypatch.setattr(urls, "KEYS_PER_PART", 20)
    got = urls.judge_urls(pages, urls.RULES, listed)
    assert got.where("(verdict = 'block') <> (page_id % 7 = 0)").isEmpty() and got.count() == 300


def test_empty_tables(spark):
    none = frame(spark, [])
    assert licenses.scan_licenses(none).isEmpty() and near.near_groups(none).isEmpty() and repeats.remove_repeats(none).isEmpty()
    assert ngrams.backoff_scores(none).isEmpty() and exact.exact_groups(none).isEmpty() and lines.line_classes(none).isEmpty()
    assert exact.drop_exact(none).columns == near.drop_near(none).columns == none.columns
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert urls.judge_urls(pages, urls.RULES, urls.junk_hosts(pages)).isEmpty()


@pytest.mark.parametrize("limit", [1, 2, 5, 9, 31])
def test_many_distances_at_once(limit):
    """All pairs in step against one pair at a time, over lengths around the band, copies, and other alphabets."""
    import random

    import numpy as np

    rng = random.Random(limit)
    texts = ["", "a", "ab" * 40, "é" * 70]
    for n in (3, 10, 30, 64, 65, 130, 400):
        base = "".join(rng.choice("abc é漢") for _ in range(n))
        texts.append(base)
        for edits in (1, 2, 5, 9, 12, 30, 33):
            x = list(base)
            for _ in range(edits):
                at = rng.randrange(len(x) + 1)
                x[at : at + rng.choice([0, 1])] = rng.choice(["", "z", "q", "a"])
            texts.append("".join(x))
    side = lines._read([t.encode() for t in texts])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    got = lines.banded_within(side, i, j, limit)
    want = [lines.banded_distance(texts[a], texts[b], limit) <= limit for a, b in zip(i.tolist(), j.tolist())]
    assert got.tolist() == want and 0 < sum(want) < len(want)
