"""HTML extraction, WARC archives and nearest neighbours."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import ann, html_extract, warc

PAGES = "page_id long, url string, html string, offset long, payload string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "http://a/1", None), (2, None, ""), (3, "http://a/\n3 é%20", "<p>x"), (4, "u", "<p>x"), (None, "u", "<p>x"), (5, "u", "<div " + "y" * 200_000),
            (4, "u", "<p>x"), (6, "u", "line\r\n\r\nWARC/1.1\r\nContent-Length: 7\r\n\r\nend")]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], PAGES)


def test_blocks_of_odd_markup():
    cut = lambda page: [b.text for b in html_extract.blocks(page)]
    assert cut("<p>a&amp;b <b>c</b>d<br>e<p>f  \n g") == ["a&b cd e", "f g"]
    assert cut("<script>var x = '</p>';</script>a<!-- b <p> -->c<style>p{}</style>") == ["ac"]
    assert cut('<p title="a > b">x</p></div></p>y<') == ["x", "y<"]
    assert cut("<ul><li>a<li>b<ul><li>c</ul></ul>d") == ["a", "b", "c", "d"]
    assert cut("") == [] and cut("<!-- never ends") == [] and cut("&#x41;&eacute;&nbsp;") == ["Aé"]
    path = html_extract.blocks('<div class="Side-Bar" id=x1><p>t')[0].path
    assert path == ("div", ".side", ".bar", ".x", ".1", "p")


@pytest.mark.parametrize("page, texts", [
    ("<a " * 350_000, 1), ("<a" * 500_000 + ' " >', 1), ('<a "' * 250_001 + ">", 1), ("<!x" * 300_000, 1), ("<a \"'" * 200_000 + "> end", 1),
    ("<div>x" * 100_000, 100_000), ("<div>" * 100_000 + "</p>" * 100_000 + "x", 1), ("<b>" + "<i>" * 50_000 + "<div>" + "</b>" * 50_000 + "x", 1),
    ("<i>" * 100_000 + "<p>x" * 50_000, 50_000),
], ids=["unclosed", "names", "quotes", "declarations", "both quotes", "deep", "stray ends", "inline ends", "long paths"])
def test_broken_pages_of_a_megabyte_take_seconds(page, texts):
    begin = time.monotonic()
    found = html_extract.blocks(page)
    assert len(found) == texts and html_extract.vectors([found])[0].shape == (texts, html_extract.SIZE)
    assert time.monotonic() - begin < 30



def test_nothing_is_cut_at_tags_that_begin_like_skipped_ones():
    cut = lambda inner: [b.text for b in html_extract.blocks(f"<article><p>one</p>{inner}<p>two</p></article>")]
    for tag in ("svg-icon", "object-view", "title-bar", "style-guide", "math-field"):
        assert cut(f'<{tag} name="x"></{tag}>') == ["one", "two"]
    for empty in ('<svg class="i"/>', "<svg/>", '<svg title="a/>b" />', "<math/>", "<svg><path d='x'/>no</svg>", "<script>no</script >"):
        assert cut(empty) == ["one", "two"]
    assert cut("<p>so <math><mi>x</mi><mo>=</mo><mspace/><mn>2</mn></math> holds</p>") == ["one", "so x=2 holds", "two"]


def test_vectors_read_all_words_and_names():
    path = html_extract.blocks('<div class="col-md-4 col-sm-12 col-xs-12 sidebar"><p>t')[0].path
    assert path == ("div", *".col .md .4 .col .sm .12 .col .xs .12 .sidebar".split(), "p")
    same = " ".join(f"w{i}" for i in range(12))
    x = html_extract.vectors([html_extract.blocks(f"<p>{same} cookies</p><p>{same} letters</p>")])[0][:, html_extract.PATH:][:, :html_extract.WORDS]
    assert (x[0] != x[1]).any()
    texts = ["a", "b " * 9 + "c", " ".join(f"v{i % 50}" for i in range(1000)), "d e"]
    assert np.allclose(html_extract._word_means(texts), html_extract._word_means(texts, most=7), atol=1e-6)


def test_labeller_on_layouts_it_has_not_seen(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    model = html_extract.fitted(pages[:60], many=300)
    wrong = total = 0
    texts = sorted({b.text for p in pages[60:100] for b in html_extract.blocks(p)})
    for page, labels in html_extract.layouts(texts, np.random.default_rng(77), 120):
        found = model.label(html_extract.vectors([html_extract.blocks(page)]))[0]
        wrong += int((found != np.array(labels)).sum())
        total += len(labels)
    assert wrong <= 0.02 * total


def test_text_of_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in html_extract.extract(pages).collect():
        inside = " ".join(b.text for b in html_extract.blocks(html[r.page_id]) if "article" in b.path)
        assert (r.text, r.n_chars) == (inside, len(inside))


def test_gradient_of_the_recurrent_cell():
    rng = np.random.default_rng(0)
    w = {"w": rng.normal(size=(html_extract.SIZE, 8)).astype(np.float32) * 0.3, "u": rng.normal(size=(2, 8)).astype(np.float32), "b": np.zeros(8, np.float32)}
    x, mask = rng.normal(size=(3, 4, html_extract.SIZE)).astype(np.float32), np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], np.float32)
    out, saved = html_extract._forward(w, x, mask, True)
    grad = html_extract._backward(w, x, mask, saved, np.ones_like(out))
    for k in w:
        at = tuple(0 for _ in w[k].shape)
        up = {**w, k: w[k].copy()}
        up[k][at] += 1e-2
        down = {**w, k: w[k].copy()}
        down[k][at] -= 1e-2
        slope = (html_extract._forward(up, x, mask, False)[0].sum() - html_extract._forward(down, x, mask, False)[0].sum()) / 2e-2
        assert abs(slope - grad[k][at]) < 2e-2 * max(1, abs(slope))


def test_extraction_of_odd_rows(odd):
    got = html_extract.extract(odd).collect()
    assert len(got) == 8 and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert html_extract.extract(odd.limit(0)).count() == 0


def test_archives_round_trip(spark, odd, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    pages = pages.union(pages.limit(9).selectExpr("page_id + 1000", "url", "html")).union(odd.select("page_id", "url", "html")).repartition(3)
    rows = pages.collect()
    best = {}
    for r in rows:
        best[r.html or ""] = max(best.get(r.html or "", -1), -1 if r.page_id is None else r.page_id)
    folder = str(tmp_path / "w")
    got = warc.archived(pages, folder=folder).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    want = []
    for r in rows:
        data = (r.html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = r.page_id != best[r.html or ""]
        want.append((r.page_id, r.url, len(data), digest, "revisit" if again else "response", best[r.html or ""] if again else None))
    have = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)
    # The source is one stream; every entry of the index opens a member of its own.
    source = sorted((tmp_path / "w" / "streams").glob("*.warc.gz"))
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in source)
    members = 0
    for index in (tmp_path / "w" / "members").glob("*.jsonl"):
        for line in index.read_text().splitlines():
            at = json.loads(line)
            with open(at["archive"], "rb") as f:
                f.seek(at["offset"])
                assert gzip.decompress(f.read(at["length"])) in whole
            members += 1
    assert members == len(rows)


def test_payloads_come_back(spark, odd, tmp_path):
    normal = warc.normalise(warc.write(warc.typed(odd), str(tmp_path / "a")), str(tmp_path / "b"))
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(normal, with_payload=True).where("record_type = 'response'").collect()}
    html = {r.page_id: r.html or "" for r in odd.collect()}
    assert got and all(html[i] == text for i, text in got.items())
    assert warc.archived(odd.limit(0), folder=str(tmp_path / "c")).count() == 0


def test_each_archive_and_each_range_has_a_task(spark, tmp_path, monkeypatch):
    pages = spark.range(400, numPartitions=8).selectExpr("id as page_id", "concat('https://x/', id) as url", "repeat(concat('page ', id, ' '), 100) as html")
    archives = warc.write(warc.typed(pages.repartition(8)), f"{tmp_path}/streams")
    normal = warc.normalise(archives, f"{tmp_path}/members")
    assert normal.count() == archives.count() > 1
    assert len({r[0].rsplit("-", 1)[1] for r in normal.select("archive").collect()}) == normal.count()  # attempts of as many tasks
    monkeypatch.setattr(warc, "RANGE", 4000)
    rows = warc.read(normal)
    assert rows.rdd.getNumPartitions() > normal.count() and rows.count() == 400


def test_inflated_pieces_are_bounded():
    import gzip
    import io

    data = gzip.compress(bytes(5_000_000)) + gzip.compress(b"abc") + gzip.compress(b"")
    pieces = list(warc.inflated(io.BytesIO(data), 1 << 16))
    assert b"".join(pieces) == bytes(5_000_000) + b"abc" and max(map(len, pieces)) <= 1 << 16


def test_cut_archives_fail():
    data = gzip.compress(warc.record(1, "u", "text", "D", "response", None))
    read = lambda raw: [(h, b"".join(b)) for h, b in warc.parsed(warc.inflated(io.BytesIO(raw), 7))]
    assert len(read(data + data)) == 2
    with pytest.raises(EOFError):
        read(data[:-9])
    assert read(b"") == []


def test_small_payloads_are_responses(odd):
    got = warc.typed(odd, least=1).where("page_id in (1, 2)").collect()
    assert {r.record_type for r in got} == {"response"}


def exact(rows, queries, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q in queries:
        v = x[np.flatnonzero(ids == q)[0]]
        score = x @ v / np.linalg.norm(x, axis=1) / np.linalg.norm(v)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), score[i]) for i in order]
    return out


def test_neighbours_reach_the_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got: dict[int, list] = {}
    for r in ann.nearest(vectors, "vec_id % 50 = 0", per_shard=300).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = exact([(r.vec_id, r.embedding) for r in vectors.collect()], got, 5)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found >= 0.9 * 5 * len(want)
    assert all([s for _, s in v] == sorted((s for _, s in v), reverse=True) for v in got.values())


def test_neighbours_of_random_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict[int, set] = {}
    for r in ann.nearest(df, "vec_id % 50 = 0", per_shard=800).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = exact(rows, got, 5)
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * 30


def test_neighbours_around_large_groups(spark):
    rng = np.random.default_rng(8)
    centre, near = rng.normal(size=24), rng.normal(size=24)
    copies = [centre.tolist()] * 1000
    group = [(near + 0.02 * rng.normal(size=24)).tolist() for _ in range(500)]
    around = [((centre if i % 2 else near) + rng.normal(size=24) * 0.8).tolist() for i in range(1500)]
    rows = list(enumerate([v for i in range(1500) for v in (copies + group)[i::1500] + around[i::1500]]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict[int, list] = {}
    for r in ann.nearest(df, "vec_id % 10 < 2", per_shard=1500).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = exact(rows, got, 5)
    assert len(got) == 600
    for kind in (lambda q: q % 2 == 0 and q < 2000, lambda q: q % 2 == 0 and q >= 2000, lambda q: q % 2 == 1):
        asked = [q for q in got if kind(q)]
        assert sum(len(set(got[q]) & {i for i, _ in want[q]}) for q in asked) >= 0.95 * 5 * len(asked)
    # Of copies the smallest ids.
    assert all(got[q] == [i for i in (0, 2, 4, 6, 8, 10) if i != q][:5] for q in range(0, 2000, 10))


def test_neighbours_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (50, [0.0, 0.0], 1), (100, None, 1), (150, [1.0, None], 1), (200, [float("nan"), 1.0], 1), (250, [], 1),
            (300, [float("inf"), 1.0], 1), (3, [2.0, 0.0], 1), (2, [3.0, 0.0], 1), (4, [0.0, 1.0], 1), (4, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (7, [1.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("shard", F.lit(9)).withColumn("rank", F.lit("x"))
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(df, "vec_id % 50 = 0", k=5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 4, 0.0), (0, 4, 4, 0.0)]
    assert ann.nearest(df.limit(0), "true").count() == 0
