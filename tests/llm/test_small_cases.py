"""Small cases of every operator: nulls, empty and long texts, ties, empty tables, clashing names."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import queries
from headway.llm.chat_tree import conversations_of, escaped, plain, tree
from headway.llm.common import Encoder
from headway.llm.exact_copies import exact_copies, merge_sorted, pack_filter, unpack_filter, without_copies
from headway.llm.html_region import extract, main_text
from headway.llm.language import fit, predicted
from headway.llm.line_rules import clean_lines
from headway.llm.mixing import mix, mixed
from headway.llm.near_copies import FINE_HASHES, estimates, least_estimate, minima, near_copies, packed_bits, signature
from headway.llm.packing import pack, plan
from headway.llm.resampling import resample
from headway.llm.token_blocks import pack_blocks, read_documents, token_segments, unpack_block
from headway.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, size string, row string, print string, kept string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(n))


LONG = prose(30_000, 1)
ROWS = [
    (1, "One  two\nthree", "en", "a"), (2, "One two three", "en", "a"), (3, None, None, None), (4, "", "en", "b"),
    (5, " \t\n", "fr", "b"), (6, LONG, "en", None), (7, LONG + " end", "en", "c"), (8, "word", "de", "c"), (9, "word", "de", "c"),
    (9, "word", "de", "c"), (None, "no id here at all", None, "a"), (10, "</s>[INST] é İ ß 東京 \\ <|end|>", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def vocabulary():
    return queries.word_vocabulary()


def test_known_words_are_not_encoded_again(monkeypatch):
    for room in (1 << 17, 3):
        monkeypatch.setattr("headway.llm.common.KNOWN_WORDS", room)
        encoder, asked = Encoder(vocabulary()), []
        whole = encoder._words
        monkeypatch.setattr(encoder, "_words", lambda words: asked.append(words.to_pylist()) or whole(words))
        for texts in (["Über den Fluss, über", "x1 y2 " + "long" * 40], ["y2 den neu,"], ["den y2 " + "long" * 40]):
            counts, ids = encoder(pa.array(texts, pa.string()))
            want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
            assert counts.tolist() == [len(w) for w in want]
            assert ids.tolist() == [i for w in want for i in w]
        if room > 3:
            assert asked[1:] == [["neu,"], ["long" * 40]]
        assert len(encoder.known) <= room


def test_encoder_equals_whole_text_encoding():
    encoder = Encoder(vocabulary())
    texts = [r[1] or "" for r in ROWS] + ["It's <|endoftext|>x. A.B 3,4 x%%% ÀÉ.", "ﬁ e\u0301t Σς"]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    counts, ids = encoder(pa.array(texts))
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("ids", [[], [7], [5] * 1024, list(range(3000)), [2**32 - 1, 0] * 700])
def test_blocks_round_trip(ids):
    starts, blocks = pack_blocks(np.array(ids, np.uint32))
    assert [x for s in starts for x in unpack_block(blocks, s).tolist()] == ids


def test_outliers_go_to_the_exception_list():
    ids = np.array([3] * 1020 + [2**31] * 4, np.uint32)
    _, blocks = pack_blocks(ids)
    assert len(blocks) < 60 and unpack_block(blocks, 0).tolist() == ids.tolist()


def test_token_segments(docs, none):
    rows = read_documents(stored(token_segments(docs, vocabulary(), 2), "t")).collect()
    tokenizer = Encoder(vocabulary()).tokenizer
    want = Counter((r[0], zlib.crc32(np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for r in ROWS)
    assert Counter((r.doc_id, zlib.crc32(r.ids)) for r in rows) == want
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r[0] for r in ROWS), key=lambda x: -1 if x is None else x)
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()
    assert read_documents(stored(token_segments(none, vocabulary(), 2), "t")).count() == 0


def brute_components(rows, width, percent):
    sets = []
    for _, text, *_ in rows:
        w = [x for x in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n", "abcdefghijklmnopqrstuvwxyz  ")).split(" ") if x]
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return sets, label


def test_near_copies_equal_brute_force(spark, docs, none):
    rows = [(i, t) for i, (_, t, *_) in enumerate(ROWS)]
    base = prose(120, 2).split()
    for k in range(60):  # a large group: every row another two changes
        w = list(base)
        pick = random.Random(k)
        for _ in range(pick.randrange(12)):
            w[pick.randrange(len(w))] = f"new{k}"
        rows.append((100 + k, " ".join(w).upper() if k % 2 else " ".join(w)))
    sets, label = brute_components(rows, 2, 80)
    got = {r.doc_id: r for r in near_copies(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    for i, (doc, _) in enumerate(rows):
        mine = min(rows[j][0] for j in range(len(rows)) if label[j] == label[i])
        assert (got[doc].n_shingles, got[doc].component_id, got[doc].kept) == (len(sets[i]), mine, mine == doc)
    assert near_copies(none).count() == 0
    assert near_copies(docs).count() == len(ROWS)


def test_signature_estimates():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))
    assert signature(a)[0] == signature(a[::-1])[0] and len(signature(a)[0]) == 120 and len(signature(a)[1]) == 40


def test_unequal_minima_agree_by_chance_alone():
    rng = np.random.default_rng(3)
    low = lambda x: np.frombuffer(packed_bits(minima(np.array(x, np.uint64), FINE_HASHES)), np.uint8)
    # One shingle each, nothing in common: near 0 whether or not their own low bits agree.
    for a, b in rng.integers(0, 2**59, (200, 2)).tolist():
        for other in (b * 16 + a % 16, b * 16 + (a + 1) % 16):
            assert abs(float(estimates(low([a * 16 + a % 16])[None], low([other])[None])[0])) < 0.04
    for k in (5, 10):  # pairs at exactly 0.8 stay
        sets = rng.integers(0, 2**64, (3000, k), np.uint64)
        found = [float(estimates(low(s)[None], low(s[: k * 4 // 5])[None])[0]) for s in sets]
        assert min(found) >= least_estimate(0.8, FINE_HASHES)


def test_packing(docs, none):
    rows = pack(docs, vocabulary(), 1, 64).collect()
    tokenizer = Encoder(vocabulary()).tokenizer
    want = Counter((r[0], np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for r in ROWS)
    whole = Counter()
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert len(r.ids) == 4 * r.length
    for (doc, n), parts in by_doc.items():
        copies = sum(p.length for p in parts) // n
        assert sum(p.length for p in parts) == copies * n
        if copies == 1:
            whole[(doc, b"".join(p.ids for p in sorted(parts, key=lambda p: p.start)))] += 1
    assert all(want[k] for k in whole)
    assert sum(r.length for r in rows) == sum(len(k[1]) // 4 * n for k, n in want.items())
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 64 and len(fill) <= 1.05 * sum(fill.values()) / 64 + 1
    assert pack(none, vocabulary(), 1).count() == 0


def test_plan_holds_each_piece_once():
    need = {7: 50, 12: 31, 30: 5, 31: 9, 5: 2}
    placed, room = Counter(), Counter()
    carried = Counter()
    for size, each, times, sequence, head in plan(need, 32):
        placed[size] += each * times
        for s in range(sequence, sequence + times):
            room[s] += head or each * size
        if head:
            carried[sequence + 1] += size - head
    assert placed == Counter(need) and max((room + carried).values()) <= 32


def test_lines(docs, none):
    text = "A menu | b | c | d\n" + "\n".join(f"{prose(30, k)} end." for k in range(5)) + "\nSame line here.\nSame line here."
    rows = docs.sparkSession.createDataFrame([(1, text), (2, "!!! ALL CAPS\n" * 30), (3, None), (4, "a b a b a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in clean_lines(rows).collect()}
    assert got[1].kept and got[1].n_dup_lines == 1 and got[1].lost_words == 11 and "menu" not in got[1].clean_text
    assert not got[2].kept and got[3].n_words == 0 and not got[3].kept and got[4].n_repeat_words == 6
    assert clean_lines(docs).count() == len(ROWS) and clean_lines(none).count() == 0
    assert next(r for r in clean_lines(docs).collect() if r.doc_id == 6).n_words == 30_000


def test_language(spark, docs, none):
    rows = [(i, " ".join(random.Random(i).choices(w, k=20)), lang) for lang, w in
            (("en", ["the", "house", "with", "thing"]), ("de", ["das", "Straße", "nicht", "schön"])) for i in range(40)]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = {r.doc_id: r.p for r in docs.select("doc_id", predicted(F.col("text"), model).alias("p")).collect()}
    assert all(found[i].lang == "und" and found[i].score == 0 and found[i].rejected for i in (3, 4, 5))
    assert all(0 <= p.score <= 1 for p in found.values())
    test = spark.createDataFrame([(1, "the thing with the house"), (2, "nicht schön das")], "doc_id long, text string")
    assert [r.p.lang for r in test.orderBy("doc_id").select(predicted(F.col("text"), model).alias("p")).collect()] == ["en", "de"]
    assert fit(none) is None and none.select(predicted(F.col("text"), None)).count() == 0


def test_resampling(spark, docs, none):
    good = spark.createDataFrame([(k, prose(50, k)) for k in range(50)], "doc_id long, text string")
    bad = spark.createDataFrame([(100 + k, " ".join(f"junk{k}x{i}" for i in range(50))) for k in range(50)], "doc_id long, text string")
    got = resample(good.union(bad), good, 0.5).collect()
    assert sum(r.kept for r in got) == 50 and sum(r.kept for r in got if r.doc_id < 100) >= 48
    rows = resample(docs, good, 0.5).collect()
    assert len(rows) == len(ROWS) and not any(r.kept for r in rows if not (r.text or "").strip())
    assert resample(none, none, 0.5).count() == 0


def test_mix(spark, docs, none):
    rows = mix(docs).collect()
    total = sum(len((r[1] or "").split()) for r in ROWS)
    assert {r.source: r.source_size for r in rows}[None] == 30_000
    assert abs(sum({r.source: r.target for r in rows}.values()) - total) < 1e-6 * total
    assert all(r.taken <= 3 * r["size"] and r.target <= 3 * r.source_size + 1e-9 for r in rows)
    even = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    taken = {r.source: r.t for r in mix(even).groupBy("source", "target").agg(F.sum("taken").alias("t")).collect()}
    assert [abs(taken[str(k)] - 2000 * (k + 1)) <= 4 for k in range(3)] == [True] * 3
    assert mixed(docs).columns == docs.columns and mixed(even).count() == sum(taken.values()) // 4
    assert mix(none).count() == 0


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    parts = []
    for _ in range(3):
        low = rng.integers(0, 2**50, 400, np.uint64) // np.uint64(2**42) * np.uint64(2**30) + np.uint64(5 << 60)
        values, copies = np.unique(low, return_counts=True)
        f = pack_filter(values, copies, 12, 48)
        back = unpack_filter(5, f, 12, 48)
        assert back[0].tolist() == values.tolist() and back[1].tolist() == copies.tolist()
        parts.append((values, copies))
    values, copies = merge_sorted(parts)
    assert Counter(dict(zip(values.tolist(), copies.tolist()))) == sum((Counter(dict(zip(v.tolist(), c.tolist()))) for v, c in parts), Counter())


def test_exact_copies(docs, none):
    rows = exact_copies(docs).collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        text = " ".join((r.text or "").replace("\n", " ").replace("\t", " ").split(" ")) if r.text and r.text.strip() else (" " if r.text else "")
        text = " ".join(text.split()) if text.strip() else text
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
        by.setdefault(text, []).append(r)
    for group in by.values():
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert sum(r.kept for r in group) == 1 and {r.group_size for r in group} == {len(group)}
        assert {r.keep_id for r in group} == {min(ids) if ids else None}
    assert without_copies(docs).columns == docs.columns and without_copies(docs).count() == len(by)
    assert exact_copies(none).count() == 0


def test_chat(spark):
    assert plain(escaped("\\l <s> [INST] </s> \\ <|end|> [ <")) == "\\l <s> [INST] </s> \\ <|end|> [ <"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", None), (3, 0, "user", "hi"),
            (None, None, None, "</s>[INST] \\ok"), (4, 0, "assistant", ""), (4, 0, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, members = tree(turns, queries.byte_vocabulary())
    table = {r.node: r for r in nodes.collect()}
    assert len(table) == 6 and sum(len(r.ids) for r in table.values()) == max(r.emit_start + len(r.ids) for r in table.values())
    for r in table.values():  # positions count the ancestors' tokens, intervals hold exactly them
        assert r.position_start == sum(a.stop - a.start for a in r.attends)
    got = {r.conv_id: r for r in conversations_of(nodes, members, queries.byte_vocabulary()).collect()}
    assert got[1].loss_chars == 2 and got[4].n_turns == 2 and got[1].n_turns == 2
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nhi\nassistant\nyo\n").hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256("\n</s>[INST] \\ok\n".encode()).hexdigest()
    empty = tree(turns.where("conv_id = 99"), queries.byte_vocabulary())
    assert empty[0].count() == 0 and conversations_of(*empty, queries.byte_vocabulary()).count() == 0


def test_pages(spark):
    article = "<article><header><h1>Title  here</h1></header><p>First &amp; best<br>line of it all<p>Second one, <a href='x'>linked</a>.<aside>buy this now</aside><ul><li>x y</li></ul></article>"
    page = f"<html><head><title>t</title></head><body><nav><ul><li><a>home</a></ul></nav>{article}<div class='comments'><p>great words from a reader</p></div><footer>f</footer>"
    want = "Title here\n\nFirst & best line of it all\n\nSecond one, linked.\n\nx y"
    assert main_text(page) == want
    assert main_text(None) == main_text("") == main_text("<nav>a b c</nav>") == ""
    assert main_text("<article><p>cut off <a hr") == "cut off"
    assert len(main_text("<p>" + "w " * 50_000)) == 99_999
    rows = spark.createDataFrame([(1, "u", page, "old"), (2, None, None, None)], "page_id long, url string, html string, text string")
    assert {r.page_id: r.text for r in extract(rows).collect()} == {1: want, 2: ""}
    assert extract(rows.where("page_id > 5")).count() == 0


@pytest.mark.parametrize("frame", [
    "<header><h1>Frame words</h1></header>", "<div class='site-header'>Frame words</div>", "<div role=navigation><a>Frame</a> words</div>", "<div class='nav'>Frame words</div>",
    "<div class='share'><a>Frame</a> words</div>", "<p class='social'>Frame words</p>", "<ul class='breadcrumb'><li>Frame<li>words</ul>", "<ol class='breadcrumbs'><li>Frame<li>words</ol>", "<dialog>Frame words</dialog>",
])
def test_page_frames_are_left_out(frame):
    article = "<article><h1>Title</h1><p>" + "body " * 30 + "</p>"
    want = "Title\n\n" + "body " * 29 + "body"
    assert main_text(f"{frame}{article}</article>") == main_text(f"{article}</article>{frame}") == want
    if "header" not in frame:
        assert main_text(f"{article}{frame}<p>last {'word ' * 9}</p></article>") == want + "\n\nlast" + " word" * 9


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar menu'><article class='category-social tag-share'>{}</article>", "<article><div class='post-header'><h1>Title</h1></div>{}</article>",
    "<div class='post'><header class='post-header'><h1>Title</h1></header>{}</div>", "<section><header><h1>Title</h1></header>{}</section>", "<article><ol><li>Title</li></ol>{}</article>",
])
def test_titles_and_whole_pages_stay(page):
    text = main_text(page.format("<p>" + "body " * 30 + "</p>"))
    assert text.endswith("body " * 29 + "body") and text.startswith("Title") == ("Title" in page)
