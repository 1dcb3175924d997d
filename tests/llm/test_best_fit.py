"""Certified best-fit packing against exhaustive packing and whole-text encoding."""

import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import queries
from headway.llm.best_fit import best_fit, certificate, least_sequences, pack_whole, placed
from headway.llm.common import Encoder

LONG = " ".join(f"w{i}" for i in range(4000))
ROWS = [
    (1, "One  two\nthree"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (5, LONG), (6, "word"), (6, "word"), (None, "no id"), (None, "no id"),
    (7, "</s> <|endoftext|> é 東京"), *((100 + k, "tok " * random.Random(k).randrange(1, 90)) for k in range(300)),
]
SCHEMA = "doc_id long, text string, length string, grp string, open string, piece string"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(4)


def checked(rows, docs, room):
    """Every id of every document once and in place, sequences gapless and within room."""
    tokenizer = Tokenizer.from_file(queries.byte_vocabulary())
    want = sorted(
        ((doc, [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]) for doc, text in docs), key=lambda x: (x[0] is None, x[0] or 0)
    )
    by_place, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_place[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for parts in by_place.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    for doc, parts in by_doc.items():
        copies = [ids for d, ids in want if d == doc]
        n = len(copies[0])
        cut = [(0, n)] if n <= room else [(a, b) for a, b in zip([0, *range(n % room or room, n, room)], [*range(n % room or room, n, room), n])]
        expected = sorted((k, a, b - a, np.array(copies[0][a:b], "<u4").tobytes()) for k, (a, b) in enumerate(cut)) * len(copies)
        assert sorted((p.piece, p.start, p.length, bytes(p.ids)) for p in parts) == sorted(expected)
    assert set(by_doc) == {d for d, _ in docs}


@pytest.mark.parametrize("group_tokens", [1 << 22, 3000])
def test_pack_whole(spark, group_tokens):
    packed = pack_whole(frame(spark), queries.byte_vocabulary(), 2, room=256, group_tokens=group_tokens)
    rows = packed.collect()
    checked(rows, ROWS, 256)
    made, least = certificate(packed, 256)
    assert made == len({r.sequence_id for r in rows}) and least <= made <= least + 2


def test_empty_table(spark):
    none = pack_whole(frame(spark).where("doc_id = 99"), queries.byte_vocabulary(), 2)
    assert none.count() == 0 and certificate(none) == (0, 0)


def test_groups_exchange_documents(spark):
    """Half the lengths pair up with the other half only across groups."""
    rows = [(k, 700 if k % 2 else 324) for k in range(400)]
    made = []
    for rounds in (1, 5):
        found = placed(spark.createDataFrame(rows, "piece_id long, length int"), 1024, 20_000, rounds).collect()
        fill = defaultdict(int)
        for r in found:
            fill[r.sequence_id] += rows[r.piece_id][1]
        assert len(found) == 400 and max(fill.values()) <= 1024
        made.append(len(fill))
    assert 200 <= made[1] < made[0] and made[1] <= 206  # 200 in one group


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    checked(pack_whole(spark.createDataFrame(docs, "doc_id long, text string"), queries.byte_vocabulary(), 2).collect(), docs, 1024)
    got = queries.op12_certified_best_fit(spark, folder)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    ids = {d: [*Tokenizer.from_file(queries.byte_vocabulary()).encode(t or "", add_special_tokens=False).ids, 2] for d, t in docs[:20]}
    for r in got.where("doc_id < 20").collect():
        if r.doc_id in ids:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())


def fewest(sizes, room):
    """Fewest sequences, by trying every way."""

    @lru_cache(None)
    def rest(left):
        if not left:
            return 0
        head, tail, best = left[0], left[1:], len(left)
        for mask in range(1 << len(tail)):
            chosen = [s for k, s in enumerate(tail) if mask >> k & 1]
            if head + sum(chosen) <= room:
                best = min(best, 1 + rest(tuple(s for k, s in enumerate(tail) if not mask >> k & 1)))
        return best

    return rest(tuple(sorted(sizes, reverse=True)))


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8), st.integers(20, 30))
def test_bound_and_packing(sizes, room):
    lengths = np.array(sizes, np.int64)
    place, offset, filled = best_fit(lengths, room)
    for k, total in enumerate(filled):
        inside = sorted((o, s) for p, o, s in zip(place, offset, lengths) if p == k)
        assert [o for o, _ in inside] == np.r_[0, np.cumsum([s for _, s in inside])[:-1]].tolist() and sum(s for _, s in inside) == total <= room
    assert least_sequences(np.bincount(lengths, minlength=room + 1), room) <= fewest(sizes, room) <= len(filled)


MIXED = st.lists(st.sampled_from([*" \n\t\rab1.,'s-é東\xa0　\x0b\x00\x85🙂́A", "<|endoftext|>", "'s", "  ", " '"]), max_size=30).map("".join)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.none() | MIXED, max_size=6), st.booleans())
def test_units_give_the_ids_of_whole_texts(texts, plain):
    encoder = byte_encoder(plain)
    counts, ids = encoder(pa.array(texts, pa.string()))
    want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


@lru_cache(None)
def byte_encoder(plain):
    return Encoder(queries.byte_vocabulary(), plain)
