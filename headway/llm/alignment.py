"""Alignment of two tokenizers over the same texts.

Both tokenizations of a text cover the same bytes, so each is a rising list of token ends.
The shorter list drives a galloping search into the longer one: from where an end would
stand if the text's tokens were evenly long, steps of doubling length pass it, then halving
steps find it. Ends that both lists hold cut the tokens into groups; differences of ranks in
the other list give the tokens a token overlaps.

Every overlap is a link between an id of either vocabulary. Links are counted over the
corpus in each task first. The counts of the most frequent pairs, a bounded number, are sent
to all tasks; links of the rarer pairs meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import cut_at, encoder, gathered, least_frequent, raw, slices, stored

# Most id pairs whose counts are sent to every task, 17 bytes each.
FREQUENT_PAIRS = 1 << 20
TOKENS = "row long, doc_id long, a binary, b binary"
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
LINKED = f"row long, doc_id long, {', '.join(f'{n} long' for n in NUMBERS)}, groups string, rare array<long>"



def searched(longer: np.ndarray, wanted: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """Rank of each of ``wanted``, a rising list, in the rising list ``longer``: how many of
    its values are smaller. All are searched at once: from ``guess`` by steps of doubling
    length until the value is passed, then by halving."""
    n = len(longer)
    low = np.minimum(guess, n)
    high = low.copy()  # longer[:low] stays smaller, longer[high:] does not
    for step in (1 << k for k in range(64)):
        far = np.flatnonzero((low > 0) & (longer[np.maximum(low, 1) - 1] >= wanted))
        if not len(far):
            break
        high[far] = low[far] - 1
        low[far] = np.maximum(low[far] - step, 0)
    for step in (1 << k for k in range(64)):
        near = np.flatnonzero((high < n) & (longer[np.minimum(high, n - 1)] < wanted))
        if not len(near):
            break
        low[near] = high[near] + 1
        high[near] = np.minimum(high[near] + step, n)
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        less = longer[middle] < wanted[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    return low


def aligned(
    a_ends: np.ndarray, b_ends: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A tokens, B tokens) up to each common end, then for each A token the first B token it
    overlaps and how many.

    Both lists of ends rise over several texts, text after text; ``a_counts`` and ``b_counts``
    are the tokens of each text, whose ends agree.
    """
    if not len(a_ends):
        return (np.zeros(0, np.int64),) * 4
    swap = len(a_ends) > len(b_ends)
    (shorter, s_counts), (longer, l_counts) = ((b_ends, b_counts), (a_ends, a_counts)) if swap else ((a_ends, a_counts), (b_ends, b_counts))
    inside = np.arange(len(shorter)) - np.repeat(np.cumsum(s_counts) - s_counts, s_counts)
    pace = l_counts / np.maximum(s_counts, 1)
    guess = np.repeat(np.cumsum(l_counts) - l_counts, s_counts) + (inside * np.repeat(pace, s_counts)).astype(np.int64)
    rank = searched(longer, shorter, guess)
    met = longer[rank] == shorter
    common = np.flatnonzero(met)
    cuts = (rank[common] + 1, common + 1) if swap else (common + 1, rank[common] + 1)
    # B ends before each A end, and B ends up to it.
    if swap:
        before = np.cumsum(np.bincount(rank + met, minlength=len(longer) + 1))[: len(longer)]
        upto = np.cumsum(np.bincount(rank, minlength=len(longer) + 1))[: len(longer)]
    else:
        before, upto = rank, rank + met
    first = np.r_[0, upto[:-1]]
    return *cuts, first, before - first + 1


class Vocabularies:
    """Bytes of the ids of both tokenizers, and B's ids of texts."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        vocabulary = Tokenizer.from_file(a_path).get_vocab()
        # The character that stands for each byte, read off characters that hold all bytes of UTF-8.
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        byte_of = {}
        for c in map(chr, [*range(0x800), *range(0x800, 0xD800, 0x800), 0xE000, 0xF000, *range(0x10000, 0x110000, 0x10000)]):
            for shown, byte in zip(level.pre_tokenize_str(c)[0][0], c.encode()):
                byte_of[shown] = byte
        a = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            a[k] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.processor = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.processor.id_to_piece(k) for k in range(self.processor.get_piece_size())]
        b = [bytes([int(p[3:5], 16)]) if self.processor.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.a, self.b = pa.array(a, pa.binary()), pa.array(b, pa.binary())
        self.a_size, self.b_size = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        # No piece holds a space behind anything else: then none reaches over a word's end.
        self.by_words = not any("▁" in p.lstrip("▁") for p in pieces) and self.processor.encode("a b") == self.processor.encode("a") + self.processor.encode("b")

    def b_ids(self, spaced: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids) of B for texts with a space put before them; the distinct
        words with the spaces before them are encoded. U+2581 stands for a space here; a text that
        holds it is not given back in either case."""
        bounds, data = raw(spaced)
        if not self.by_words:
            found = [np.array(x, np.uint32) for x in self.processor.encode([t[1:] for t in spaced.to_pylist()], num_threads=1)]
            return np.array([len(x) for x in found], np.int64), np.concatenate([*found, np.zeros(0, np.uint32)])
        blank = data == 32
        opens = np.r_[blank & ~np.r_[False, blank[:-1]], True]
        opens[bounds] = True  # each text begins with its space
        starts = np.flatnonzero(opens)
        coded = cut_at(starts, data).dictionary_encode()
        names = coded.dictionary.to_pylist()
        known = self.processor.encode([w[1:] for w in names], num_threads=1)
        known = [x if w != " " else [self.processor.piece_to_id("▁")] for x, w in zip(known, names)]
        sizes = np.array([len(x) for x in known], np.int64)
        pool = np.fromiter((i for x in known for i in x), np.uint32, int(sizes.sum()))
        return gathered(coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(starts, bounds), np.cumsum(sizes) - sizes, sizes, pool)


@lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    """One of each in each Python worker, kept from task to task."""
    return Vocabularies(a_path, b_path)


def gives_back(ids: np.ndarray, counts: np.ndarray, names: pa.Array, texts: pa.Array) -> np.ndarray:
    """Whether the bytes of each text's ids are the text."""
    bounds, data = raw(texts)
    offsets, joined = raw(names.take(pa.array(ids)))
    ends = offsets[np.cumsum(counts)]
    if len(joined) == len(data) and (ends == bounds[1:]).all() and (joined == data).all():
        return np.ones(len(texts), bool)
    joined, data = joined.tobytes(), data.tobytes()
    return np.array([joined[a:b] == data[c:d] for a, b, c, d in zip(np.r_[0, ends].tolist(), ends.tolist(), bounds.tolist(), bounds[1:].tolist())], bool)


def packed_ids(ids: np.ndarray, counts: np.ndarray, kept: np.ndarray, width: int) -> pa.Array:
    """Each text's ids as bytes, none where the text is not kept."""
    offsets = np.r_[0, np.cumsum(np.where(kept, counts, 0))].astype(np.int32) * width
    data = ids[np.repeat(kept, counts)].astype(f"<u{width}").tobytes()
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def tokens_of(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, width: int) -> DataFrame:
    """Ids of both tokenizers (little-endian unsigned, ``width`` bytes) for each row; none
    where either does not give back the bytes of a space and the text."""

    def encode(batches):
        a_of, both = encoder(a_path, True), vocabularies(a_path, b_path)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch):
                texts = pc.binary_join_element_wise(" ", pc.fill_null(part.column(1), ""), "")
                a_counts, a = a_of(texts)
                b_counts, b = both.b_ids(texts)
                same = gives_back(a, a_counts, both.a, texts) & gives_back(b, b_counts, both.b, texts) & (np.diff(raw(texts)[0]) > 1)
                ids = [packed_ids(x, n, same, width) for x, n in ((a, a_counts), (b, b_counts))]
                yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(len(same)), pa.int64()), part.column(0), *ids], ["row", "doc_id", "a", "b"])
                row += len(same)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("t")).mapInArrow(encode, TOKENS)


def ids_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of each row, all ids in order) of a binary column."""
    bounds, data = raw(column)
    return np.diff(bounds) // width, data.view(f"<u{width}").astype(np.int64)


class Links:
    """All links of a slice of rows. ``pairs`` holds, row after row, the id of A times 2^32
    plus that of B; ``of_row`` the links of each row, ``a_cut`` and ``b_cut`` the tokens up to
    each group's end."""

    def __init__(self, a_column: pa.Array, b_column: pa.Array, width: int, a_path: str, b_path: str):
        a_size, b_size = vocabularies(a_path, b_path).a_size, vocabularies(a_path, b_path).b_size
        self.a_counts, self.a = ids_of(a_column, width)
        self.b_counts, self.b = ids_of(b_column, width)
        self.a_cut, self.b_cut, first, many = aligned(np.cumsum(a_size[self.a]), np.cumsum(b_size[self.b]), self.a_counts, self.b_counts)
        of_a = np.repeat(np.arange(len(self.a)), many)
        of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(many) - many - first, many)
        self.pairs = self.a[of_a] << 32 | self.b[of_b]
        self.of_row = self.summed(many, self.a_counts)
        stops = np.cumsum(self.a_counts)
        self.groups = np.diff(np.searchsorted(self.a_cut, stops, "right"), prepend=0)

    @staticmethod
    def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sums of ``values`` over runs of ``counts``, in whole numbers."""
        return np.diff(np.r_[0, np.cumsum(values, dtype=np.int64)][np.r_[0, np.cumsum(counts)]])

    def texts(self) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` for each row: the ids of each group."""
        bits = int(max(self.a.max(initial=0), self.b.max(initial=0))).bit_length()
        a_mark, b_mark = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        a_mark[self.a_cut - 1], b_mark[self.b_cut - 1] = 1, 2
        b_mark[np.cumsum(self.b_counts)[self.b_counts > 0] - 1] = 3
        a_each, b_each = np.diff(self.a_cut, prepend=0), np.diff(self.b_cut, prepend=0)
        out = np.empty(len(self.a) + len(self.b), np.int64)
        out[np.arange(len(self.a)) + np.repeat(self.b_cut - b_each, a_each)] = a_mark << bits | self.a
        out[np.arange(len(self.b)) + np.repeat(self.a_cut, b_each)] = b_mark << bits | self.b
        offsets, data = raw(decimal_names(bits).take(pa.array(out)))
        return cut_at(offsets[np.r_[0, np.cumsum(self.a_counts + self.b_counts)]], data)


@lru_cache(maxsize=1)
def decimal_names(bits: int) -> pa.Array:
    """Ids below 2^bits in decimal, before a comma, a bar, a semicolon and alone."""
    return pa.array([f"{k}{mark}" for mark in (",", "|", ";", "") for k in range(1 << bits)], pa.string())


def pair_counts(tokens: DataFrame, a_path: str, b_path: str, width: int) -> DataFrame:
    """(pair, n, best): links of each id pair in the corpus, and whether no pair of the same
    B id has more. Each task adds up its own links first, as far as they fit."""

    def merged(held):
        pairs, n = (np.concatenate(x) for x in zip(*held))
        values, at = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(values), np.int64)
        np.add.at(total, at, n)
        return values, total

    def count(batches):
        held = []
        for batch in batches:
            for part in slices(batch, size=1 << 22):
                held.append(np.unique(Links(part.column(0), part.column(1), width, a_path, b_path).pairs, return_counts=True))
                if sum(len(v) for v, _ in held) > 1 << 22:
                    held = [merged(held)]
                    if len(held[0][0]) > 1 << 21:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held.pop()], ["pair", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in merged(held)], ["pair", "n"])

    made = tokens.select("a", "b").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    made = stored(made.withColumn("b_id", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pairs")
    most = made.groupBy("b_id").agg(F.max("n").alias("most"))  # one row per id of the vocabulary
    return made.join(F.broadcast(most), "b_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shown: Callable[[Column], Column] = lambda groups: groups,
    frequent_pairs: int = FREQUENT_PAIRS,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links that
    no other A id exceeds for their B id in the corpus), ``count_sum`` (counts of the links'
    pairs) and ``groups`` (``a1,a2|b1;...``, the ids of each group; empty without tokens).
    ``shown`` takes of the groups' text what is kept of it, before rows move.

    A null or empty text, and one that either tokenizer does not give back byte by byte, has
    no tokens: zeros. Rows that share an id or have none stay rows of their own and count
    each; an empty table gives no row. Other columns are left out, whatever their names.
    """
    spark = docs.sparkSession
    width = 2 if max(len(vocabularies(a_path, b_path).a), len(vocabularies(a_path, b_path).b)) <= 1 << 16 else 4
    tokens = stored(tokens_of(docs, a_path, b_path, id_col, text_col, width), "aligned-tokens", "zstd")
    pairs = stored(pair_counts(tokens, a_path, b_path, width), "pair-counts")
    least = least_frequent(pairs, frequent_pairs)
    frequent = pairs.where(F.col("n") >= least).toArrow().sort_by("pair")  # at most frequent_pairs rows
    sent = spark.sparkContext.broadcast([frequent.column(c).to_numpy() for c in ("pair", "n", "best")])

    def link(batches):
        known, counts, best = sent.value
        for batch in batches:
            for part in slices(batch, size=1 << 22):
                found = Links(part.column(2), part.column(3), width, a_path, b_path)
                values, at = np.unique(found.pairs, return_inverse=True)
                place = np.searchsorted(known, values)
                rare = np.ones(len(values), bool)
                n, top = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
                inside = np.flatnonzero(place < len(known))
                inside = inside[known[place[inside]] == values[inside]]
                rare[inside], n[inside], top[inside] = False, counts[place[inside]], best[place[inside]]
                where = np.flatnonzero(rare[at])
                owner = np.repeat(np.arange(part.num_rows), found.of_row)[where]
                numbers = [found.a_counts, found.b_counts, found.groups, found.of_row, found.summed(top[at], found.of_row), found.summed(n[at], found.of_row)]
                rest = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)), pa.int32()), pa.array(found.pairs[where], pa.int64())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(x, pa.int64()) for x in numbers), found.texts(), rest],
                    ["row", "doc_id", *NUMBERS, "groups", "rare"],
                )

    made = tokens.mapInArrow(link, LINKED).select("row", "doc_id", *NUMBERS, shown(F.col("groups")).alias("groups"), "rare")
    made = stored(made, "aligned")
    links = made.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("links"))
    sums = links.join(pairs.where(F.col("n") < least), "pair").groupBy("row")
    sums = sums.agg(F.sum(F.when(F.col("best"), F.col("links"))).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more"))
    both = made.join(sums, "row", "left")
    more = {"n_best": F.coalesce("more_best", F.lit(0)), "count_sum": F.coalesce("more", F.lit(0))}
    return both.select("doc_id", *[(F.col(c) + more[c]).alias(c) if c in more else c for c in NUMBERS], "groups")
