"""The filter audit, the ranked search and the archive converter against brute force on small tables."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from tideline.llm import audit, search, warc

WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, lang string, n_words string, score string, bits string"


def texts(seed: int, n: int) -> list[str | None]:
    r = random.Random(seed)
    fixed = [None, "", " \t\n", "é😀 É x", "Word " * 300, "word " * 300, "a#b " * 250, "x" * 70 + " " + "x" * 71, "y" * 50_000 + " y"]
    made = [" ".join(r.choice(["a", "B", "cc", "été", "x" * 65, "%", "Zoo", "\v"]) for _ in range(r.choice([0, 1, 5, 150, 260]))) for _ in range(n)]
    return fixed + made


# Filter audit


def counted(text: str | None) -> list[int]:
    t = text or ""
    words = re.findall(WORD, t)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))]


@pytest.mark.parametrize("window", [7, 64, 1 << 20])
def test_one_pass_counts_as_regular_expressions_do(monkeypatch, window):
    monkeypatch.setattr(audit, "WINDOW", window)
    some = texts(1, 20) if window > 7 else texts(1, 20)[:8]
    got = audit.count([None if t is None else t.encode() for t in some])
    assert [list(map(int, row)) for row in zip(*got)] == [counted(t) for t in some]


def test_words_with_equal_hashes_stay_apart(monkeypatch):
    monkeypatch.setattr(audit.SpanTable, "_hashes", lambda self, start, length, doc: (start * 0).astype("uint64"))
    some = ["a b a c", "a b", "x" * 70 + " " + "x" * 69 + "y " + "x" * 70]
    assert audit.count([t.encode() for t in some])[1].tolist() == [3, 2, 2]


def audited(rows, labels) -> set[tuple]:
    """The definition, order by order."""
    marks = {i: (any(x[1] == 1 for x in labels if x[0] == i), any(x[2] == 1 for x in labels if x[0] == i)) for i, *_ in labels if i is not None}
    facts = []
    for i, t, lang in rows:
        n, distinct, capitals, points, symbols = counted(t)
        again = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, _ in rows)
        failed = {x for x, bad in zip("ABCDE", (n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * points, symbols > 0, again)) if bad}
        facts.append((lang or "", failed, *marks.get(i, (False, False))))
    out = []
    for part in {f[0] for f in facts}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [f for f in facts if f[0] == part]
            for step, x in enumerate(order):
                gone = [f for f in left if x in f[1]]
                earlier = [f for f in facts if f[0] == part and x in f[1] and f not in left]
                left = [f for f in left if x not in f[1]]
                shapley[x] += len(gone)
                only = sum(f[0] == part and f[1] == {x} for f in facts)
                out.append([part, "".join(order), step + 1, len(left), len(gone), len(earlier), only, sum(f[2] for f in gone), sum(f[3] for f in gone), x, shapley])
    return {(*row[:9], row[10][row[9]]) for row in out}


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_every_order_played_through(spark):
    some = texts(2, 25)
    rows = [(i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(some)]
    rows += [(40, some[9], "en"), (41, some[9], "de"), (41, some[9], "de"), (2, some[10], "en"), (None, some[9], "en"), (None, "", None)]
    labels = [(i, i % 2, (i + 1) % 3) for i in range(0, 30, 2)] + [(4, 1, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS)
    got = audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = [tuple(r) for r in got.select(COLUMNS).collect()]
    assert len(got) == len(set(got)) == 600 * 3
    assert set(got) == audited(rows, labels)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert audit.audit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# Ranked search


def terms(text: str | None) -> list[str]:
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(TERM, text or "")]


def ranked(docs, items, k=50) -> set[tuple]:
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w in held)
    out = []
    for name, text in items:
        scores = []
        for i, words in held:
            score = 0
            for term in set(terms(text)):
                df, tf = sum(term in w for _, w in held), words.count(term)
                if tf:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * (50 + 50 * len(words) * n_docs // total)))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(name, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
@pytest.mark.parametrize("k", [3, 50])
def test_search_equals_brute_force(spark, block_bytes, k):
    r = random.Random(5)
    vocabulary = ["a", "ab", "b", "É", "é", "straße", "x1", "12", "the", "foo", "bar", "日本"]
    docs = [(i, r.choice([" ", "-", "\n", "@"]).join(r.choice(vocabulary) for _ in range(r.randint(0, 40)))) for i in range(60)]
    docs += [(70, None), (71, ""), (72, "?!"), (3, docs[3][1]), (None, "foo bar the"), (73, "The FOO" * 2000), (74, "foo_bar [foo] @foo")]
    items = [(f"i{i}", " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 6)))) for i in range(12)]
    items += [("none", None), ("empty", ""), ("marks", "..."), (None, "FOO"), ("far", "nowhere"), ("twice", "foo foo")]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, rank int, score int, item_id int")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    assert found(search.search(df, benchmark, k=k, block_bytes=block_bytes)) == ranked(docs, items, k)


@pytest.mark.parametrize(("cells", "candidates"), [(1, 1), (16, 20), (1 << 20, 1 << 19)])
def test_scores_and_best_candidates_in_pieces(monkeypatch, cells, candidates):
    monkeypatch.setattr(search, "CELLS", cells)
    monkeypatch.setattr(search, "CANDIDATES", candidates)
    r = random.Random(3)
    weights = np.array([r.randint(1, 20_000) for _ in range(9)])
    items = [r.sample(range(9), r.randint(1, 6)) for _ in range(5)]
    scorer, best, every = search.Scorer(weights, items, 1000, 50_000), search.Best(5, 4, pa.int64()), []
    for start in range(0, 300, 50):
        docs = [{t: r.randint(1, 4) for t in r.sample(range(9), r.randint(1, 9))} for _ in range(50)]
        n = np.array([r.randint(10, 20) for _ in docs])
        want = [[sum(int(weights[t]) * (10**9 * d[t] // (1000 * d[t] + 20 * (50 + 50 * int(size) * 1000 // 50_000))) for t in terms if t in d) for terms in items] for d, size in zip(docs, n)]
        edge = np.cumsum([0, *map(len, docs)])
        got = scorer.scores(n, edge, np.array([t for d in docs for t in d]), np.array([c for d in docs for c in d.values()]))
        assert got.tolist() == want
        best.add(pa.array(range(start, start + 50)), got)
        every += [(item, -score, start + i) for i, row in enumerate(want) for item, score in enumerate(row) if score]
    top = [x for item in range(5) for x in sorted(e for e in every if e[0] == item)[:4]]
    assert [(x["item"], -x["score"], x["id"]) for x in best.trim().to_pylist()] == top


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "foo")], "item_id long, text string")
    assert search.search(none, some).count() == 0
    assert search.search(some.withColumnRenamed("item_id", "doc_id"), some.limit(0)).count() == 0


# Archives


def test_versions_of_arc_are_read_by_their_declared_lengths():
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"
    for version in (1, 2):
        blocks = [http + b"text\n\nhttp://fake/ 1.2.3.4 20200101000000 text/html 5\n", b"", b"plain\r\n\r\nbody", http]
        archive = warc.arc_opening(version, "a.arc", "20200102030405")
        for i, block in enumerate(blocks):
            archive += warc.arc_header(version, ["http://x/a b", None, "http://é/", "u"][i], "1.2.3.4", "20200102030405", "text/html", len(block), "a.arc") + block + b"\n"
        for content in (archive, gzip.compress(archive[:50]) + gzip.compress(archive[50:])):
            got = list(warc.read_arc(warc.Source(content, "a")))
            assert [r.block for r in got] == blocks
            assert [r.uri for r in got] == ["http://x/a%20b", None, "http://%C3%A9/", "u"]
            assert all(archive[r.offset :].startswith((r.uri or "-").encode()) for r in got)
        with pytest.raises(ValueError, match="before a record does"):
            list(warc.read_arc(warc.Source(archive[:-10], "a")))
    with pytest.raises(ValueError, match="version 3"):
        list(warc.read_arc(warc.Source(b"filedesc://a 0.0.0.0 2020 text/plain 8\n3 0 x\nU\n\n", "a")))
    spaced = warc.arc_opening(1, "a", "2020") + b"http://x/a b c 1.2.3.4 2020 text/html 2\nhi\n"
    assert [r.uri for r in warc.read_arc(warc.Source(spaced, "a"))] == ["http://x/a b c"]


def test_dates_and_records_are_as_warc_writes_them():
    assert warc.warc_date("20200102030405") == "2020-01-02T03:04:05Z"
    assert warc.warc_date("2020") == "2020-01-01T00:00:00Z"
    row = {"path": "p", "offset": 7, "uri": "http://x/", "ip": "1.2.3.4", "date": "20200102030405", "kind": "text/html", "block": b"HTTP/1.0 200 OK\r\n\r\nbody", "first": None}
    (made,) = warc.read_warc(warc.Source(warc.converted(row), "w"))
    assert made.block == row["block"]
    assert made.fields["warc-type"] == "response" and made.fields["warc-ip-address"] == "1.2.3.4"
    assert made.fields["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"body").digest()).decode()
    assert made.fields["warc-record-id"] == warc.record_id("p", 7)
    (resource,) = warc.read_warc(warc.Source(warc.converted(row | {"block": b"plain"}), "w"))
    assert resource.fields["warc-type"] == "resource" and resource.fields["content-type"] == "text/html"


PAGES = [
    (5, "http://a/", "same"), (3, None, "same"), (9, "http://b/ c\n", "same"), (1, "http://c/", None), (2, "http://d/", ""), (4, "é", "日本\r\n\r\nWARC/1.1\r\n"),
    (None, "http://e/", "same"), (None, "http://f/", "alone"), (7, "http://g/", "x" * 300_000), (8, "http://h/", "HTTP/1.1 200 OK\r\n\r\nnested"), (6, "u", "z"), (6, "u", "z"),
]


def held(pages, revisit_from=0):
    out = []
    for i, _, html in pages:
        body = (html or "").encode()
        same = sorted(j for j, _, h in pages if (h or "").encode() == body and j is not None)
        first = same[0] if same else None
        again = len(body) >= revisit_from and (i != first or same and i is None)
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first if again else None))
    twice = [r for r in out if r[0] == 6]
    if revisit_from <= 1:
        out[-1] = (*twice[1][:3], "revisit", 6)
    return sorted(out, key=repr)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("archive_bytes", [1, 32 << 20])
def test_archives_say_what_was_written(spark, version, archive_bytes):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, path string, key string").repartition(2)
    got = warc.archive(pages, version=version, archive_bytes=archive_bytes)
    assert sorted((tuple(r)[:5] for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == held(PAGES)
    assert got.select("record_id").distinct().count() == len(PAGES)


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = warc.archive(pages, revisit_from=4).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == held(PAGES, 4)


def test_payloads_come_back_byte_for_byte(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_arc(pages, str(tmp_path / "arc"))
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    bodies = {r.key: warc.payload_of(bytes(r.block))[1].decode() for r in warc.warc_records(spark, str(tmp_path / "warc")).filter("type = 'response'").collect()}
    assert bodies["7"] == "x" * 300_000 and bodies["4"] == PAGES[5][2] and bodies["8"] == PAGES[9][2] and bodies["1"] == ""


def test_archives_of_nothing(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
