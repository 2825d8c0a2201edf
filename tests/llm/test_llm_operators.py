"""Each operator on awkward rows and on no rows, and against brute force on small tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import blocks, decontam, html, langid, lines, lm, near, packing, quality, topk, urls, words
from tideline.llm.queries import QUERIES, identified

LONG = " ".join(f"Word{i % 977} is number {i}." for i in range(6_000))
STORY = "The cat sat on the mat and the dog lay down by the fire while it rained all day in the old town by the sea."
ROWS = [
    (1, "", "en"),
    (2, None, None),
    (3, "!!! ???\n\n--", "de"),
    (4, "A word.", "en"),
    (5, LONG, "en"),
    (6, LONG, None),
    (6, LONG, None),
    (None, STORY + " " + STORY.upper(), "en"),
    (8, "Été à la plage.\nÉté à la plage.\n" + STORY + "\nEin Ende.", "fr"),
    (9, STORY.replace("cat", "cow") + " " + STORY, "en"),
]
CLASH = "id k c h n g w words first last spans items hits score lang_pred n_words n_hit removed_words comp class_id ids start a b rule verdict __k".split()


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.withColumns({name: F.lit("x") for name in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.limit(0)


# --- near duplicates ---------------------------------------------------------------------------


def test_near_classes_of_awkward_rows(awkward, nothing):
    got = sorted((r.doc_id or 0, r.class_id or 0) for r in near.near_classes(awkward).collect())
    # Texts without words are copies; a null id comes last in its class.
    assert got == [(0, 9), (1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5), (6, 5), (8, 8), (9, 9)]
    assert near.near_classes(nothing).count() == 0
    kept = near.keep_first(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [1, 4, 5, 8, 9]
    assert near.keep_first(nothing).count() == 0


def altered(rng, text, share):
    out = text.split()
    for i in range(len(out)):
        if rng.random() < share:
            out[i] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_classes_equal_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3_000)]
    common = " ".join(rng.choices(vocabulary, k=60))
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(30, 200))) for _ in range(60)]
    texts += [altered(rng, t, share) for t in texts[:30] for share in (0.004, 0.015, 0.03)]
    # Near copies of one original around the threshold, and a passage that many texts share.
    texts += [altered(rng, texts[0], 0.02) for _ in range(80)]
    texts += [common + " " + " ".join(rng.choices(vocabulary, k=30)) for _ in range(80)]
    texts += texts[:10]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    flat, edge = words.hashed(texts)
    shingles = [words.grams(flat[a:b], 5) for a, b in itertools.pairwise(edge.tolist())]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if near.aligned_similarity(shingles[a], shingles[b], 0.8) >= 0.8:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.doc_id: r.class_id for r in near.near_classes(df).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


def set_similarity(a, b):
    """Jaccard similarity of the sets of five-word tuples."""
    one, two = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(one & two) / len(one | two)


def test_a_repeat_does_not_hide_what_texts_share(spark):
    rng = random.Random(5)
    line = [" ".join(f"v{rng.randrange(3_000)}" for _ in range(20)) for _ in range(12)]
    base = "\n".join(line)
    docs = [base, base + "\n" + line[-1], "\n".join([*line, line[3], *line[:2]]), "\n".join(line[:11] + [" ".join(f"v{rng.randrange(3_000)}" for _ in range(20))])]
    shingles = [words.grams(words.hashed([t])[0], 5) for t in docs]
    assert set_similarity(docs[0], docs[1]) > 0.95
    for a, b in itertools.combinations(range(len(docs)), 2):
        want = set_similarity(docs[a], docs[b])
        assert near.aligned_similarity(shingles[a], shingles[b], 0.8) == pytest.approx(want)
    got = near.near_classes(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_repeated_lines_leave_a_text_near_itself(spark):
    rng = random.Random(6)
    docs = []
    for i in range(0, 120, 4):
        line = [" ".join(f"v{rng.randrange(30_000)}" for _ in range(60)) for _ in range(8)]
        docs += [(i, "\n".join(line)), *((i + j, "\n".join(x for x in line for _ in range(n))) for j, n in ((1, 2), (2, 5)))]
        docs += [(i + 3, "\n".join(line * 5))]
    for (_, a), (_, b) in ((docs[i], docs[i + j]) for i in range(0, 120, 4) for j in (1, 2, 3)):
        one, two = (words.grams(words.hashed([t])[0], 5) for t in (a, b))
        assert np.isin(near.sketch(one, 16, 3), near.sketch(two, 16, 3)).any()
        assert near.aligned_similarity(one, two, 0.8) == pytest.approx(set_similarity(a, b))
    got = near.near_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i - i % 4 for i, _ in docs}


def test_alignment_is_bounded_by_jaccard_and_sees_order():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    assert near.aligned_similarity(a, a, 0.8) == 1.0
    half = np.concatenate((a[150:], a[:150]))
    assert near.aligned_similarity(a, half, 0.8) == 0  # every match is too far away
    swapped = np.concatenate((a[:100], a[130:160], a[100:130], a[160:]))
    assert near.aligned_similarity(a, swapped, 0.8) == 0.9
    b = np.concatenate((a[:20], rng.integers(0, 1 << 62, 10).astype(np.uint64), a[30:]))
    assert near.aligned_similarity(a, b, 0.8) == pytest.approx(290 / 310)


# --- packing -----------------------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_packing_round_trip(awkward, nothing):
    tokenizer = Tokenizer.from_file(PATH)
    pieces = packing.pack(awkward, PATH, window=256).collect()
    sequences, documents = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
        documents.setdefault(p.doc_id, []).append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and 0 < p.length == len(p.ids) // 4
            at += p.length
        assert at <= 256
    for doc_id, text, _ in ROWS:
        want = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        copies = 2 if doc_id == 6 else 1
        got = sorted(documents[doc_id], key=lambda p: p.start)
        assert sum(p.length for p in got) == copies * len(want) and {p.doc_tokens for p in got} == {len(want)}
        for p in got:
            assert p.ids == want[p.start : p.start + p.length].tobytes()
    total = sum(p.length for p in pieces)
    sizes = [sum(p.length for p in parts) for parts in sequences.values()]
    assert sum(0 if n & (n - 1) == 0 else 256 - n for n in sizes) < 0.1 * total
    assert packing.pack(nothing, PATH).count() == 0


def test_words_encode_as_whole_texts():
    import pyarrow as pa

    tokenizer, encoder = Tokenizer.from_file(PATH), packing.WordEncoder(PATH)
    texts = ["It's 3.14 o'clock!!", "naïve Façade... ÀÉ×÷ ß", "日本語 テキスト。", "a b é İx", "x\t\ny\r\n\x0b\x0cz", "#a% b@c (d) e-f", "", " "]
    ids, sizes, *_ = encoder.encode(pa.array(texts))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_cuts_cost_least():
    rng = np.random.default_rng(1)
    for _ in range(30):
        stops = np.concatenate(([0], np.cumsum(rng.integers(1, 9, 40))))
        cost = rng.integers(0, 6, len(stops)).astype(float)
        best, back = packing.cut(stops, cost, 20)
        brute = [0.0]
        for i in range(1, len(stops)):
            brute.append(min(brute[j] + 20 - (stops[i] - stops[j]) + cost[i] for j in range(i) if stops[i] - stops[j] <= 20))
        assert best == brute
        way = [0, *packing.way(back, len(stops) - 1)]
        assert sum(20 - (stops[b] - stops[a]) + cost[b] for a, b in itertools.pairwise(way)) == best[-1]
    assert packing.tail(4096, 4096, 16.0) == (0.0, [4096])
    assert packing.tail(1030, 4096, 16.0)[1] == [1024, 4, 2]
    assert packing.tail(4095, 4096, 16.0)[1] == [4095]


# --- main text ---------------------------------------------------------------------------------


def test_main_text_leaves_furniture_out(spark):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style><script>x = "</p>"</script></head><body>
    <header><a href=/>Site</a></header><nav><ul><li><a href=a>One</a></ul></nav><div class="cookie-notice">We use cookies on this site.</div>
    <article><h1>A title</h1><p>First &amp; best&nbsp;of   all<br>the <b>parts</b> of it.<p>Second.</p><div class="ad">Buy it now, it is the best of the best.</div>
    <!-- <p>no</p> --><p>if a &lt; b or 1 < 2 then the &#233;nd</p></article>
    <aside>See the other parts of the site</aside><form>Name <input> of the user</form><section id="comments"><p>I think that it is the best of all the parts.</p></section>
    <footer>&copy; us</footer></body></html>"""
    want = "A title\n\nFirst & best of all the parts of it.\n\nSecond.\n\nif a < b or 1 < 2 then the énd"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p>"), (5, "u", "<div" * 1_000), (1, "u", page), (6, "u", "<article>" + "<p>the text of it</p>" * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("x"), "rows": F.lit(1)})
    got = {(r.page_id): r for r in html.extract(df).collect()}
    assert got[1].text == want and got[1].n_chars == len(want) and got[1].rows == 1
    assert [got[i].text for i in (2, 3, 4)] == ["", "", ""]
    assert got[6].text == "\n\n".join(["the text of it"] * 20_000)
    assert html.extract(df).count() == len(rows) and html.extract(df.limit(0)).count() == 0


def test_undecided_blocks_follow_their_neighbours():
    good = "<p>This is a part of the text that has all of the words it needs to be kept by the rules, as it is long and not a menu at all. It goes on and on, so that it is over the limit for the long ones of the page.</p>"
    bad = "<p><a href=x>Links links links links links links links links links</a></p>"
    assert html.main_text(good + "<p>Yes.</p>" + good).count("Yes.") == 1
    assert "No." not in html.main_text(good + bad + "<p>No.</p>" + bad)


# --- quality -----------------------------------------------------------------------------------


def test_quality_learns_and_scores_everything(spark, awkward, nothing):
    rng = random.Random(2)
    good = [" ".join(rng.choices(["the", "of", "house", "river", "and", "stone."], k=80)) for _ in range(60)]
    bad = [t.upper().replace(" ", "!! ") for t in good]
    rows = [(i, t, int(t in good)) for i, t in enumerate(good + bad)] + [(999, None, 1), (1000, "", None)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, quality int").withColumn("y", F.lit(0))
    network = quality.learn(labelled.where("doc_id % 3 != 1"))
    got = {r.doc_id: r.score for r in quality.score(labelled, network).collect()}
    assert len(got) == len(rows)
    held = [i for i, _, _ in rows[:120] if i % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == rows[i][2] for i in held]) > 0.95
    scores = [r.score for r in quality.score(awkward, network).collect()]
    assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)
    assert quality.learn(labelled.limit(0)) is None
    assert {r.score for r in quality.score(awkward, None).collect()} == {0.5}
    assert quality.score(nothing, network).count() == 0


def test_chunks_cover_the_text_and_gradients_are_right():
    shape = quality.Shape(chunk=16, overlap=4, width=3, filters=3, hidden=4)
    for n in (0, 1, 15, 16, 17, 28, 29, 100):
        text = bytes(range(1, n + 1)) if n < 250 else b""
        chunks = quality.chunks_of(text, shape)
        joined = chunks[0].tobytes() + b"".join(c[4:].tobytes() for c in chunks[1:])
        assert joined[:n] == text and not joined[n:].strip(b"\0")
    rng = np.random.default_rng(0)
    net = quality.Network(shape)
    chunks, counts = rng.integers(0, 256, (5, 16)).astype(np.uint8), np.array([2, 3])
    labels, weights = np.array([1.0, 0.0]), np.ones(2)
    grad = net.gradient(chunks, counts, labels, weights)

    def loss():
        p = net.score(chunks, counts)
        return -(np.log(p[0]) + np.log(1 - p[1])) / 2

    for name in ("w1", "w2", "b1", "b2"):
        value = net.params[name].astype(np.float64)
        net.params[name] = value
        at = (0,) * value.ndim
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        down = loss()
        value[at] += 1e-5
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_quality_score_equals_a_naive_network():
    shape = quality.Shape(chunk=16, overlap=4, width=3, filters=3, hidden=4)
    net = quality.Network(shape)
    p = {k: v.astype(float) for k, v in net.params.items()}
    for text in (b"", b"short", b"A longer text of several chunks, read to its end."):
        step, hidden = shape.chunk - shape.overlap, []
        for at in range(0, max(1, len(text) - shape.overlap), step):
            piece = text[at : at + shape.chunk].ljust(shape.chunk, b"\0")
            top = [max(sum(p["filters"][j, piece[i + j], f] for j in range(3)) for i in range(14)) for f in range(3)]
            hidden.append([max(0.0, sum(top[f] * p["w1"][f, n] for f in range(3)) + p["b1"][n]) for n in range(4)])
        both = [sum(h[n] for h in hidden) / len(hidden) for n in range(4)] + [max(h[n] for h in hidden) for n in range(4)]
        want = 1 / (1 + math.exp(-sum(x * w for x, w in zip(both, p["w2"])) - p["b2"][0]))
        chunks = quality.chunks_of(text, shape)
        assert net.score(chunks, np.array([len(chunks)]))[0] == pytest.approx(want, abs=1e-5)


def test_quality_trains_with_all_chunks_of_a_text(spark):
    shape = quality.Shape(chunk=16, overlap=4, width=3, filters=3, hidden=4)
    texts = ["x" * 5_000 + "END", None, ""]
    rows = spark.createDataFrame([(t, n % 2) for n, t in enumerate(texts)], "text string, quality int")
    got = quality._training_chunks(rows, "text", "quality", shape)
    assert sorted(len(c) for c, _ in got) == sorted(len(quality.chunks_of((t or "").encode(), shape)) for t in texts)
    assert any(b"END" in c.tobytes() for c, _ in got)


def test_quality_counts_labelled_texts_without_dealing_them_out(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(n, "word " * n) for n in range(40)] + [(None, "x"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(0, 40, 3)] + [(3, 1)], "doc_id long, quality int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    plans, frame = [], type(docs)
    first = frame.first
    monkeypatch.setattr(frame, "first", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or first(df))
    assert QUERIES["op4_quality"](spark, str(tmp_path)).count() == 42
    (plan,) = plans
    above = plan[: plan.index("Join")]
    assert "octet_length" not in above and "octet_length" in plan


# --- line dedup --------------------------------------------------------------------------------


def brute_lines(docs, least):
    """Texts as lists of the words that stay: a run of ``least`` words goes if the first place of its words is apart from it."""
    words = {i: (t or "").split() for i, t in docs}
    first = {}
    for i, _ in docs:
        low = [w.lower() for w in words[i]]
        for p in range(len(low) - least + 1):
            first.setdefault(tuple(low[p : p + least]), (i, p))
    out = {}
    for i, _ in docs:
        low, gone = [w.lower() for w in words[i]], set()
        for p in range(len(low) - least + 1):
            j, q = first[tuple(low[p : p + least])]
            if j != i or p - q >= least:
                gone.update(range(p, p + least))
        out[i] = ([w for p, w in enumerate(words[i]) if p not in gone], len(gone))
    return out


@pytest.mark.parametrize("least,letters", [(12, "abcdefgh"), (25, "ab"), (9, "abcd")])
def test_line_dedup_equals_brute_force(spark, least, letters):
    rng = random.Random(least)
    docs = []
    for i in range(150):
        words = rng.choices([x + y + rng.choice(["", "", "."]) for x in letters for y in letters], k=rng.randrange(0, 90))
        if rng.random() < 0.1:
            words += rng.choices(["x", "y z", "Q"], k=1) * rng.randrange(1, 90)
        for _ in range(rng.randrange(0, 4)):
            other = rng.choice(docs)[1].split() if docs else words
            a, n, at = rng.randrange(len(other) + 1), rng.randrange(least - 3, 4 * least), rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() if rng.random() < 0.1 else w for w in other[a : a + n]]
        docs.append((i, "".join(w + rng.choice([" ", " ", "\n", "\t ", "\n\n"]) for w in words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.text.split(), r.removed_words) for r in lines.dedup_lines(df, least=least).collect()}
    want = brute_lines(docs, least)
    assert got == want and sum(n > 0 for _, n in want.values()) > 40


def test_line_dedup_of_a_passage_inside_lines(spark):
    passage = " ".join(f"w{n}" for n in range(60))
    around = ["Start {} end.", "{}, in front", "Before:\n{}.", "one two three {} four. Five\n\nSix", "{}"]
    docs = [(n, a.format(passage)) for n, a in enumerate(around)]
    got = {r.doc_id: (r.text, r.removed_words, r.removed_runs) for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    # The last word of a passage differs where a mark follows it.
    assert got[0] == (docs[0][1], 0, 0) and got[4] == ("", 60, 1)
    assert got[1] == ("w59, in front", 59, 1) and got[2] == ("Before:\nw59.", 59, 1)
    assert got[3] == ("one two three four. Five\n\nSix", 60, 1)


def test_line_dedup_keeps_white_space_elsewhere():
    assert lines.keep("a  b\nc d\t e", [[1, 1]]) == ("a\nc d\t e", 1)
    assert lines.keep(" a b c ", [[0, 0], [2, 2]]) == ("b", 2)
    assert lines.keep("a b", [[0, 1]]) == ("", 2)


def test_line_dedup_leaves_only_what_its_result_reads(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(root))
    text = " ".join(f"w{n}" for n in range(90))
    out = lines.dedup_lines(spark.createDataFrame([(1, text), (2, "a " + text), (3, text[:200])], "doc_id long, text string"))
    left = {name.rpartition("-")[0] for name in set(os.listdir(root)) - before}
    assert "line-hashes" not in left and "line-near" not in left and "line-judged" in left
    assert [r.text for r in out.orderBy("doc_id").collect()][:2] == [text, "a"]


def test_cuts_touch_or_stay_apart():
    cuts = np.sort(np.array([(3 << 32) + 5, (6 << 32) + 6, (4 << 32) + 4, (9 << 32) + 12]))
    assert lines._merged(cuts) == [(3, 6), (9, 12)]


def test_lines_travel_in_blocks_and_not_as_rows(spark, monkeypatch):
    """A row for each line and run of words, shuffled and sorted, was most of the processor's time."""
    settled, settle = [], blocks.settle
    monkeypatch.setattr(blocks, "settle", lambda df, purpose: settled.append((purpose, out := settle(df, purpose), out.count())) or out)
    monkeypatch.setattr(lines, "discard", lambda *frames: None)
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefghijkl", k=rng.randrange(20, 300))) for _ in range(60)]
    docs = [(i, rng.choice([t, f"{rng.choice(texts)} {t}", None, ""])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.removed_words for r in lines.dedup_lines(df).collect()} == {i: n for i, (_, n) in brute_lines(docs, 25).items()}
    assert [(purpose, n <= 4) for purpose, _, n in settled] == [("line-hashes", True), ("line-windows", True)]
    prints, numbers = settled[0][1], lines.PRINT
    assert prints.agg(F.sum("n")).first()[0] > 300
    # Every row whose key is met twice comes back with its document, and no other.
    every = []
    for r in prints.collect():
        place, *columns = (blocks.unpack(r[c], t) for c, t in ({"place": np.int32} | numbers).items())
        every += zip((r.id[i] for i in place), *(c.tolist() for c in columns))
    met = Counter(h for _, h, *_ in every)
    # The smallest hashes of many would nearly all go to one bucket.
    assert max(Counter(h >> 62 for h in met).values()) < 0.4 * len(met)
    got = [tuple(r) for r in blocks.repeats(prints, "h", numbers).select("id", *numbers).collect()]
    assert sorted(got) == sorted(r for r in every if met[r[1]] > 1) and 0 < len(got) < len(every)


def test_fingerprints_equal_a_naive_search():
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["a", "b"] if i % 2 else "abcdefghij", k=rng.randrange(70))) for i in range(30)] + [None, "", "x " * 90]
    runs = lines.Runs(texts)
    for least in (9, 10, 13, 25, 40):
        at, row, hashes = lines.fingerprints(runs, least)
        want = {(first + int(np.argmin(hashes[first : first + least - 8])), d) for d, (a, b) in enumerate(zip(runs.edge, runs.edge[1:])) for first in range(a, b - least + 1)}
        assert list(zip(at, row)) == sorted(want)


def test_words_between_white_space_are_told_apart():
    rng = random.Random(7)
    some = ["".join(rng.choices("aàb\0Ü。\u2028", k=n)) for n in (*range(1, 20), 63, 64, 65, 66, 500) for _ in range(3)] + ["a" * n for n in range(1, 140)]
    texts = [None, "", " ", "\t\x0b\x0c\r\n"] + ["".join(w + rng.choice([" ", "\n", "\x0b\t", " \x0c "]) for w in rng.choices(some, k=90)) for _ in range(9)] + ["end", ""]
    hashes, edge = words.spaced(texts)
    split = [(t or "").lower().encode().split() for t in texts]
    assert edge.tolist() == [0, *np.cumsum([len(ws) for ws in split])]
    of: dict = {}
    assert all(of.setdefault(w, h) == h for w, h in zip((w for ws in split for w in ws), hashes.tolist()))
    assert len(hashes) == edge[-1] and len(set(of.values())) == len(of) > 150
    assert words.spaced([])[1].tolist() == [0]


def test_line_dedup_of_awkward_rows(awkward, nothing):
    out = lines.dedup_lines(awkward)
    assert set(out.columns) == set(awkward.columns) | {"removed_words", "removed_runs"}
    got = sorted(((r.doc_id or 0), r.text, r.removed_runs) for r in out.where("doc_id is null or doc_id != 2").collect())
    by = {i: (t, n) for i, t, n in got}
    assert len(got) == len(ROWS) - 1 and by[1] == ("", 0) and by[5] == (LONG, 0)
    assert by[6] == ("", 1)  # both of the equal rows
    assert by[0][0].startswith(STORY)
    # STORY has 26 words: its first occurrence (null id) stays, later ones go.
    assert by[8][0] == "Été à la plage.\nÉté à la plage.\nEin Ende." and STORY not in by[9][0]
    assert by[0][0] == STORY and by[9][0] == "The cow"
    assert out.where("doc_id = 2").first().text is None
    assert lines.dedup_lines(nothing).count() == 0


# --- decontamination ---------------------------------------------------------------------------


def brute_decontam(docs, items, width=13):
    out = {}
    for d, text in docs:
        w, hit, found = decontam.words_of(text.encode() if text else None), set(), set()
        for i, item in items:
            v = decontam.words_of(item.encode() if item else None)
            for at in range(max(1, len(v) - width + 1) if v else 0):
                window = v[at : at + width]
                for p in range(len(w) - len(window) + 1):
                    if w[p : p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        found.add(str(i))
        out[d] = (len(w), len(hit), sorted(found))
    return out


def test_decontamination_equals_brute_force_at_any_block_size(spark):
    rng = random.Random(6)
    some = lambda n: " ".join(rng.choices(["alpha", "Beta", "gamma,", "ünd", "x1"], k=n))
    items = [(i, some(rng.randrange(1, 30))) for i in range(12)] + [(50, None), (51, "?!")]
    docs = [(i, some(20) + ". " + rng.choice(items[:12])[1].upper() + "; " + some(rng.randrange(40))) for i in range(40)] + [(100, None), (101, "")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_decontam(docs, items)
    results = []
    for size in (1 << 20, 200):
        rows = decontam.decontaminate(df, bench, block_bytes=size).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in rows} == want
        results.append(sorted((r.doc_id, r.spans) for r in rows))
        for r in rows:
            for a, b in r.spans:
                assert decontam.words_of(r.text[a:b].encode())[0] and not r.text[a].isspace() and not r.text[b - 1].isspace()
            assert sum(len(decontam.words_of(r.text[a:b].encode())) for a, b in r.spans) == r.n_hit
            assert r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)
    assert results[0] == results[1]


def test_decontamination_of_awkward_rows(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, STORY), (None, "A word."), (1, STORY)], "item_id long, text string")
    got = {(r.doc_id or 0): r for r in decontam.decontaminate(awkward, bench).collect()}
    assert got[4].contaminated and got[4]["items"] == [] and got[4].n_hit == 2
    assert got[0]["items"] == ["1"] and got[0].n_hit == got[0].n_words
    assert not got[1].contaminated and not got[2].contaminated and got[2].n_words == 0
    assert decontam.decontaminate(awkward, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.decontaminate(nothing, bench).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


# --- top-k -------------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 12))
    base[100:250] = base[7]  # a third of the vectors are the same
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(base)]
    rows += [(1000, None), (1001, [1.0, None]), (1050, [float("nan")] * 12), (1100, [float("inf")] * 12), (1150, []), (1200, [1.0, 2.0]), (None, rows[3][1]), rows[5]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit(1), "shard": F.lit(2), "dim": F.lit(3), "score": F.lit(4)})
    whole = np.floor(256 * np.asarray([v for _, v in rows[:400]])).astype(np.int64)
    want = set()
    for q in range(0, 400, 50):
        scores = whole @ whole[q]
        order = sorted((c for c in range(400) if c != q), key=lambda c: (-scores[c], c))[:5]
        want |= {(q, r + 1, c, int(scores[c])) for r, c in enumerate(order)}
    for sizes in ({}, {"shard_rows": 50, "block_rows": 3, "leaf": 4}):
        assert {tuple(r) for r in topk.top_k(df, **sizes).collect()} == want
    assert topk.top_k(df.limit(0)).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert topk.top_k(few).count() == 2


# --- url filter --------------------------------------------------------------------------------


def test_url_rules(spark):
    rules = [urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"), urls.Rule("example.com", "/de/", "block"), urls.Rule("org", "/fr/", "allow")]
    cases = [
        ("http://Example.NET/en/x?y#z", "example.net", "/en/x", "example.net/en/", "allow"),
        ("http://a.example.net/", "a.example.net", "/", "net/", "block"),
        ("http://a.net", "a.net", "", None, "allow"),
        ("http://net?/x", "net", "", None, "allow"),
        ("http://net/", "net", "/", "net/", "block"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("ftp://x.example.com/de/a", "x.example.com", "/de/a", "example.com/de/", "block"),
        ("x.example.com/de/a", "", "", None, "allow"),
        ("http://evil.com/.net/", "evil.com", "/.net/", None, "allow"),
        ("http://a.org/FR/", "a.org", "/FR/", None, "allow"),
        ("://a.org/fr/://b", "a.org", "/fr/://b", "org/fr/", "allow"),
        ("http://É.net/" + "y" * 5_000, "É.net", "/" + "y" * 5_000, "net/", "block"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "page_id long, url string").withColumns({"rule": F.lit(1), "verdict": F.lit(2), "host": F.lit(3)})
    judged = urls.judge(urls.canonical(df), rules)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    assert urls.judge(urls.canonical(df.limit(0)), rules).count() == 0
    assert {r.verdict for r in urls.judge(urls.canonical(df), [], "block").collect()} == {"block"}


def test_globs_equal_fnmatch():
    import fnmatch

    rng = random.Random(9)
    globs = ["".join(rng.choices("ab*?", k=rng.randrange(0, 12))) for _ in range(60)]
    texts = ["".join(rng.choices("abc", k=rng.randrange(0, 14))) for _ in range(200)]
    got = urls.ShiftAnd(globs).match([t.encode() for t in texts])
    assert got.tolist() == [[fnmatch.fnmatchcase(t, g) for g in globs] for t in texts]


# --- language ----------------------------------------------------------------------------------


def test_language_of_awkward_rows(spark, awkward, nothing):
    english = ["the house of the king was on the hill", "she has been there for a long time and the others with her"]
    german = ["das Haus des Königs war auf dem Hügel", "sie ist schon lange dort und die anderen mit ihr zusammen"]
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, "en") for t in english * 9] + [(t, "de") for t in german * 9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    model = langid.learn(docs, pieces)
    assert model[0] == ["de", "en"]
    test = spark.createDataFrame([(1, "the others of the house"), (2, "die anderen des Hauses"), (3, "123 !?"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(test, model, pieces).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["en", "de", "und", "und"] and got[3].score == 0 and 0.5 < got[1].score <= 1
    out = identified(awkward).collect()
    assert len(out) == len(ROWS) and {r.lang_pred for r in out if r.doc_id in (1, 2, 3)} == {"und"}
    assert identified(nothing).count() == 0


def test_forward_sums_over_all_segmentations():
    pieces = {"▁": 0, "▁a": 1, "a": 2, "b": 3, "ab": 4, "▁ab": 5, "ba": 6}
    table = np.array([[0.1], [0.2], [0.15], [0.1], [0.05], [0.3], [0.1], [0.0], [1e-7]])

    def total(s):
        return 1.0 if not s else sum(table[pieces[s[:k]], 0] * total(s[k:]) for k in range(1, min(3, len(s)) + 1) if s[:k] in pieces)

    for word in ("abab", "aabb", "bbaa"):
        lattice = langid.Lattice([word], pieces, 3)
        assert np.exp(lattice.forward(table, 3)[0][0, 0]) == pytest.approx(total("▁" + word))
        used = np.zeros_like(table)
        lattice.expected(table, np.array([2.0]), 3, used)
        size = np.array([len(p) for p in pieces] + [0, 1])
        assert (used[:, 0] * size).sum() == pytest.approx(2 * (len(word) + 1))
    long_word = "ab" * 3_000
    assert np.isfinite(langid.Lattice([long_word], pieces, 3).forward(table, 3)[0]).all()


# --- language-model scores -----------------------------------------------------------------------


def test_lm_scores_of_awkward_rows_in_any_plan(awkward, nothing):
    plans = [{}, {"head": 0}, {"broadcast_words": 0}, {"broadcast_words": 0, "head": 5}]
    got = [sorted(((r.doc_id or 0), r.n_words, r.log_score, r.score is None) for r in lm.score(awkward, **p).collect()) for p in plans]
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) == len(ROWS)
    assert got[0][1] == (1, 0, 0, True)
    assert lm.score(nothing).count() == 0


def test_bigram_scores_are_the_same_in_any_plan(awkward):
    plans = [{}, {"head": 0}, {"broadcast_words": 0}, {"broadcast_words": 0, "head": 5}]
    got = [sorted((r.doc_id or 0, r.log_score) for r in lm.score(awkward, order=2, least=2, **p).collect()) for p in plans]
    assert got[0] == got[1] == got[2] == got[3]


@pytest.mark.parametrize("order, least", [(2, 2), (3, 1), (4, 1), (5, 1), (3, 2), (4, 2)])
def test_lm_scores_equal_a_backoff_chain(spark, order, least):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices("abcdef", k=rng.randrange(0, 30)))) for i in range(40)]
    docs += docs[:3]
    count = {}
    for _, t in docs:
        w = t.split()
        for n in range(1, order + 1):
            for i in range(len(w) - n + 1):
                g = tuple(w[i : i + n])
                count[g] = count.get(g, 0) + 1
    log = lambda x: round(np.log(x) * 1e6)
    total = sum(n for g, n in count.items() if len(g) == 1)

    def word(run):
        if len(run) == 1:
            return log(count[run]) - log(total)
        return log(count[run]) - log(count[run[:-1]]) if count[run] >= least else log(0.4) + word(run[1:])

    want = sorted((i, sum(word(tuple(t.split()[max(0, e - order) : e])) for e in range(1, len(t.split()) + 1))) for i, t in docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted((r.doc_id, r.log_score) for r in lm.score(df, order=order, least=least).collect()) == want


def test_counts_travel_in_blocks_and_not_as_rows_of_runs(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", 7)
    rng = random.Random(3)
    docs = [(i, rng.choice([None, "", "one", "two words", " ".join(rng.choices("abcdef", k=rng.randrange(60)))])) for i in range(80)]
    df = spark.createDataFrame(docs, "id long, text string").repartition(3)
    kept = blocks.keep_words(df, words.SPACED, "test-words")
    schema = df.selectExpr("id", "text AS counts").schema

    def work(slice, counts):
        return [slice.row["id"], pa.array([str(counts[a:b].tolist()) for a, b in zip(slice.edge[:-1], slice.edge[1:])])]

    got = {r.id: r.counts for r in blocks.with_counts(kept, lambda s: words.mix(s.of[s.index]), 10, work, schema).collect()}
    split = {i: (t or "").split() for i, t in docs}
    met = Counter(w for ws in split.values() for w in ws)
    assert got == {i: str([met[w] for w in ws]) for i, ws in split.items()}
    # A row for each document and run is what filled the disk.
    plan = lm.score(df, id="id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "bucket" in plan


def test_crc_of_pieces_is_little_endian():
    assert zlib.crc32(np.array([1, 2], dtype="<u4").tobytes()) == zlib.crc32(b"\x01\0\0\0\x02\0\0\0")


def test_number_signs_are_no_letters():
    assert langid.words_in("½ ² Ⅷ ① Été x_y 12ab x²y 日本 ǅ") == ["été", "x", "y", "ab", "x", "y", "日本", "ǆ"]
    assert langid.words_in("½ ² Ⅷ ①") == []


# --- main text: what must not be lost, time, neighbours ------------------------------------------

FIRST = "The first paragraph of this article says that it is about the things which we have seen in the town."
LATER = "This was the second paragraph and it is also about the things that we have seen in the town, LATER."


@pytest.mark.parametrize("between", ["<svg/>", "<video-player src=x>v</video-player>", "<title-card>t</title-card>", "<select><option>one<option>two", "<video>", "<object><p>none</object>"])
def test_text_after_an_odd_element_stays(between):
    assert html.main_text(f"<article><p>{FIRST}</p>{between}<p>{LATER}</p></article>").endswith(LATER)


@pytest.mark.parametrize("more", [LATER + " © the author", f"<a href=x>{LATER}</a>"])
def test_paragraphs_with_a_sign_or_a_link_stay_in_an_article(more):
    assert "LATER" in html.main_text(f"<article><p>{FIRST}</p><p>{more}</p></article>")


@pytest.mark.parametrize("name", ["post category-social", "share-enabled"])
def test_class_of_an_article_alone_loses_nothing(name):
    assert html.main_text(f'<body><article class="{name}"><p>{LATER}</p></article></body>') == LATER


@pytest.mark.parametrize("name", ["layout has-sidebar", "row no-header"])
def test_class_that_tells_the_layout_loses_nothing(name):
    assert html.main_text(f'<body><div class="{name}"><p>{LATER * 3}</p></div></body>') == LATER * 3


def test_furniture_goes_whatever_its_density():
    page = f"""<body><article><p>{FIRST}</p></article><section class="comments"><article class="comment"><p>{LATER * 4}</p></article></section>
    <div class="site-footer">{LATER * 3}</div><div class="cookie-banner">{LATER * 3}</div><div hidden>{LATER * 3}</div></body>"""
    assert html.main_text(page) == FIRST


def test_pages_in_an_unlisted_language_are_judged_by_length_and_links():
    text = "Pitkä kappale, jossa kerrotaan kaupungin historiasta, asukkaista, rakennuksista ynnä kaduista. " * 3
    assert html.main_text(f'<body><ul><li><a href=x>Etusivu</a></li></ul><div><p>{text}</p></div></body>') == text.strip()


@pytest.mark.parametrize("bad", ["<div ", '<a href="', "<!--", "<select>", "<a '>", "<", "<script>", "<p><b class=ad>", "<div>", "</div>"])
def test_broken_markup_takes_linear_time(bad):
    start = time.perf_counter()
    for end in ("", ">", '"', "</select>"):
        html.main_text(bad * (200_000 // len(bad)) + end)
    assert time.perf_counter() - start < 12


def test_neighbours_decide_as_a_naive_search_says():
    rng = random.Random(4)
    texts = ["Short one", "It was the town that we have seen and it is the one which they had. " * 4, "Lorem ipsum dolor " * 15]
    for _ in range(200):
        blocks = [(html.Block(linked=0 if rng.random() < 0.8 else len(t)), t) for t in rng.choices(texts, k=rng.randrange(1, 12))]
        rules = [None if t == texts[0] and not b.linked else t == texts[1] and not b.linked for b, t in blocks]
        if not any(t == texts[1] for _, t in blocks):
            continue
        want = []
        for i, known in enumerate(rules):
            for far in range(1, len(rules)):
                if known is not None:
                    break
                near = [rules[j] for j in (i - far, i + far) if 0 <= j < len(rules) and rules[j] is not None]
                known = any(near) if near else None
            want.append(bool(known))
        assert html.classify(blocks, html.Rules()) == want


def test_items_without_an_id_count_but_are_not_listed(spark):
    docs = spark.createDataFrame([(1, "one two three and more"), (2, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "one two three"), ("b", "two three and"), (None, "and more")], "item_id string, text string")
    for size in (1 << 20, 8):
        got = decontam.decontaminate(docs, bench, block_bytes=size).orderBy("doc_id").select("n_hit", "n_items", "items").collect()
        assert [tuple(r) for r in got] == [(5, 2, ["b"]), (0, 0, [])]
