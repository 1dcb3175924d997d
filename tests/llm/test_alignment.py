"""Alignment of two tokenizers against plain loops."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import queries
from headway.llm.alignment import align, aligned, searched, vocabularies

TEXTS = [
    (1, "One  two\nthree"), (2, None), (3, ""), (4, " \t\n"), (5, "Straße, 東京 🙂 naïve é don't"), (6, "the the the the cat"),
    (6, "the the the the cat"), (None, "no id <s> <|endoftext|> </s>"), (7, "▁ lower block"), (8, "word " * 3000), (9, "\x00\x07 odd\xa0space"),
]
SCHEMA = "doc_id long, text string, row string, a string, pair string"


def level_bytes():
    """Byte of each character of a byte-level vocabulary, as its authors publish the rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def brute(rows):
    tokenizer = Tokenizer.from_file(queries.byte_vocabulary())
    tokenizer.encode_special_tokens = True
    names = {i: t for t, i in tokenizer.get_vocab().items()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=queries.piece_vocabulary())
    level = level_bytes()
    found, counts = [], Counter()
    for doc, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        a_bytes = [bytes(level[c] for c in names[i]) for i in a]
        b_bytes = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            found.append((doc, [], [], [], ""))
            continue
        spans = []
        for parts in (a_bytes, b_bytes):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        counts.update(links)
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, at = [], 0
        for end in common:
            inside = [[str(x) for x, (s, e) in zip(ids, sp) if at <= s and e <= end] for ids, sp in zip((a, b), spans)]
            groups.append("|".join(",".join(g) for g in inside))
            at = end
        found.append((doc, a, b, links, ";".join(groups)))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(
        ((doc, len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), g) for doc, a, b, links, g in found),
        key=str,
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def test_alignment_equals_plain_loops(spark):
    want = brute(TEXTS)
    for frequent in (1 << 20, 5, 0):  # all pairs sent, few, none: the join does the rest
        got = align(frame(spark, TEXTS), queries.byte_vocabulary(), queries.piece_vocabulary(), frequent_pairs=frequent)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert sum(w[1] > 0 for w in want) >= 7 and next(w for w in want if w[0] == 7)[1:] == (0,) * 6 + ("",)


def test_empty_tables(spark):
    none = frame(spark, TEXTS).where("doc_id = 99")
    assert align(none, queries.byte_vocabulary(), queries.piece_vocabulary()).count() == 0
    blank = frame(spark, [(1, None), (2, "")])
    assert [tuple(r)[1:] for r in align(blank, queries.byte_vocabulary(), queries.piece_vocabulary()).collect()] == [(0,) * 6 + ("",)] * 2


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_galloping_alignment(spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in brute(rows)]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


rising = st.lists(st.integers(1, 9), max_size=60).map(lambda x: np.cumsum(x, dtype=np.int64))


@settings(deadline=None)
@given(rising, rising, st.randoms())
def test_search_from_any_guess(longer, wanted, pick):
    guess = np.array([pick.randint(0, len(longer)) for _ in wanted], np.int64)
    if len(longer):
        assert searched(longer, wanted, guess).tolist() == np.searchsorted(longer, wanted).tolist()


@settings(deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 29)), st.sets(st.integers(1, 29))), min_size=1, max_size=5))
def test_groups_and_overlaps(texts):
    a = [sorted({*x, 30}) for x, _ in texts]
    b = [sorted({*y, 30}) for _, y in texts]
    flat = [np.array([30 * k + e for k, ends in enumerate(lists) for e in ends]) for lists in (a, b)]
    counts = [np.array([len(x) for x in lists]) for lists in (a, b)]
    a_cut, b_cut, first, many = aligned(*flat, *counts)
    common = sorted(set(flat[0]) & set(flat[1]))
    assert a_cut.tolist() == [sum(flat[0] <= c) for c in common] and b_cut.tolist() == [sum(flat[1] <= c) for c in common]
    starts = [np.r_[0, x[:-1]] for x in flat]
    for i in range(len(flat[0])):
        meets = [j for j in range(len(flat[1])) if starts[1][j] < flat[0][i] and flat[1][j] > starts[0][i]]
        assert meets == list(range(first[i], first[i] + many[i]))


MIXED = st.lists(st.sampled_from([*" \n\t\rab1.,'é東\xa0　\x00\u200bﬁ½", "<s>", "</s>", "<unk>", "  ", "   ", "the", "<0x0A>"]), max_size=25).map("".join)


@settings(deadline=None, max_examples=200)
@given(st.lists(MIXED, max_size=5))
def test_words_give_the_ids_of_whole_texts(texts):
    both = vocabularies(queries.byte_vocabulary(), queries.piece_vocabulary())
    counts, ids = both.b_ids(pa.array([" " + t for t in texts], pa.string()))
    want = both.processor.encode(texts)
    kept = [bool(t) for t in texts]  # an empty text has no tokens whatever its space gives
    assert both.by_words and [c for c, k in zip(counts.tolist(), kept) if k] == [len(w) for w, k in zip(want, kept) if k]
    assert ids[np.repeat(kept, counts).astype(bool)].tolist() == sum((w for w, k in zip(want, kept) if k), [])
