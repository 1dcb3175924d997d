"""Phrase collocations: word sequences found oftener than their parts suggest.

Sequences are counted level by level, by their number of words. Frequent words get ids;
longer sequences are counted only where their first and their last words but one are
frequent themselves, which loses nothing, since no sequence is more frequent than its parts.

In each task a trie over word ids counts them: its first levels branch by a word, below
them hash containers hold what follows. A container that grows too large bursts into a
branch by its next word. When the trie is full, the largest subtrees are spilled as sorted
runs. Runs of all tasks meet by prefix and are added up.

The ids of the most frequent words, a bounded number, are sent to every task; rarer words
that are still frequent enough travel by their text. What tells frequent sequences from
others is a bitmap of fixed size; a false hit costs a count that is dropped later, never a
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import cut_at, least_frequent, raw, slices, stored
from headway.llm.near_copies import mixed_bits

# A piece ends at these, words at blanks.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)], KIND[list(PIECE_ENDS)] = 1, 2

# Words whose ids are sent to every task.
DICTIONARY_WORDS = 1 << 20
# Bits of the map of frequent sequences, 8 MiB.
MAP_BITS = 1 << 26
# Sequences a trie holds before it spills, and a container before it bursts.
TRIE_SEQUENCES = 1 << 19
CONTAINER_SEQUENCES = 1 << 13
# Words of the prefix that runs meet by.
PREFIX_WORDS = 3
# Bytes of text that a task works on at once.
SLICE_BYTES = 1 << 22
# Parts in which the best of a language are found before they meet.
TOP_PARTS = 64
# From this code on, a word stands in the task's own list and not in the dictionary.
OWN = 1 << 31
OUTSIDE = b"\xff"


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(words in order, a number of the piece of each) of texts without null, A-Z in lower
    case. Numbers rise and differ between pieces and texts."""
    bounds, data = raw(texts)
    if not len(data):
        return pa.array([], pa.string()).dictionary_encode(), np.zeros(0, np.int64)
    data = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    kind = KIND[data]
    inside = kind == 0
    opens = np.zeros(len(data) + 1, bool)
    opens[bounds] = True
    opens[1:-1] |= inside[1:] != inside[:-1]
    starts = np.flatnonzero(opens)
    is_word = inside[starts[:-1]]
    firsts = starts[:-1][is_word]
    piece = np.cumsum(kind == 2, dtype=np.int32)[firsts] + np.searchsorted(bounds, firsts, "right")
    return cut_at(starts, data).filter(pa.array(is_word)).dictionary_encode(), piece


def by_language(batches) -> Iterator[tuple[str, pa.Array]]:
    """(language, its texts) of each slice of rows with a language and a text."""
    for batch in batches:
        for part in slices(batch, size=SLICE_BYTES):
            langs, texts = pc.fill_null(part.column(0), "und"), pc.fill_null(part.column(1), "")
            for lang in pc.unique(langs).to_pylist():
                yield lang, texts.filter(pc.equal(langs, lang))


def counted_words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n) of single words."""

    def count(batches):
        for lang, texts in by_language(batches):
            found = words_of(texts)[0]
            n = np.bincount(found.indices.to_numpy(zero_copy_only=False), minlength=len(found.dictionary))
            langs = pa.array([lang] * len(n), pa.string())
            yield pa.RecordBatch.from_arrays([langs, found.dictionary, pa.array(n, pa.int64())], ["lang", "phrase", "n"])

    return docs.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


class Codes:
    """Numbers of frequent words in one task: the id of those in the dictionary, an own number
    from OWN on of others that the map lets pass, -1 of the rest."""

    def __init__(self, dictionary: dict[str, tuple[int, pa.Array]], others: np.ndarray | None):
        self.dictionary, self.others = dictionary, others
        self.own: list[bytes] = []
        self.number: dict[bytes, int] = {}
        self.prints = np.zeros(0, np.uint64)

    def of(self, lang: str, words: pa.Array) -> np.ndarray:
        first, known = self.dictionary.get(lang, (0, pa.array([], pa.string())))
        place = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.where(place >= 0, first + place, -1)
        if self.others is not None:
            rest = np.flatnonzero(codes < 0)
            names = [outside(lang, w) for w in words.take(pa.array(rest)).to_pylist()]
            prints = word_prints(names)
            fresh = []
            for k in np.flatnonzero(passes(self.others, prints)).tolist():
                if names[k] not in self.number:
                    self.number[names[k]] = len(self.own)
                    self.own.append(names[k])
                    fresh.append(prints[k])
                codes[rest[k]] = OWN + self.number[names[k]]
            self.prints = np.r_[self.prints, np.array(fresh, np.uint64)]
        return codes

    def prints_of(self, codes: np.ndarray) -> np.ndarray:
        """A 64-bit print of each word, the same in all tasks."""
        prints = mixed_bits(codes.astype(np.uint64) + np.uint64(1))
        own = codes >= OWN
        if own.any():
            prints[own] = self.prints[codes[own] - OWN]
        return prints

    def written(self, grams: np.ndarray) -> list[bytes]:
        """Each row of numbers as bytes that mean the same in all tasks."""
        return [b"".join(self.own[c - OWN] if c >= OWN else c.to_bytes(4) for c in row) for row in grams.tolist()]


def outside(lang: str, word: str) -> bytes:
    """A word not in the dictionary, as it is written into a sequence."""
    name = f"{lang}\0{word}".encode()
    return OUTSIDE + len(name).to_bytes(4) + name


def word_prints(names: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))


def read(gram: bytes, names: list[tuple[str, str]]) -> tuple[str, list[str], list[int | bytes]]:
    """(language, words, parts) of a written sequence."""
    words, parts, at = [], [], 0
    while at < len(gram):
        if gram[at : at + 1] == OUTSIDE:
            size = 5 + int.from_bytes(gram[at + 1 : at + 5])
            lang, word = gram[at + 5 : at + size].decode().split("\0", 1)
            parts.append(gram[at : at + size])
            at += size
        else:
            code = int.from_bytes(gram[at : at + 4])
            lang, word = names[code]
            parts.append(code)
            at += 4
        words.append(word)
    return lang, words, parts


def sequence_prints(prints: np.ndarray, words: int) -> np.ndarray:
    """Print of the ``words`` words from each place on, from the prints of single words."""
    n = max(len(prints) - words + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(words):
        total = mixed_bits(total * np.uint64(0x9E3779B97F4A7C15) + prints[k : k + n])
    return total


def passes(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & np.uint64(MAP_BITS - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def bit_map(prints: DataFrame) -> np.ndarray:
    """Map of the prints in a column ``print``; at most MAP_BITS / 64 rows reach the driver."""
    at = F.col("print").bitwiseAND(F.lit(MAP_BITS - 1))
    word = F.shiftright(at, 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(print & 63 as int))")
    rows = prints.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(MAP_BITS // 64, "<i8")
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return bits.view(np.uint8)


class HatTrie:
    """Counts of sequences of ``words`` word numbers.

    ``root`` maps the first number to a subtree: a hash container (what follows, as bytes, to
    its count) or, once burst, a branch from the next number to containers. ``sizes`` holds
    the sequences below each first number.
    """

    def __init__(self, words: int, most: int = TRIE_SEQUENCES, container: int = CONTAINER_SEQUENCES):
        self.words, self.most, self.container = words, most, container
        self.root: dict[int, tuple[bool, dict]] = {}
        self.sizes: dict[int, int] = {}
        self.held = 0

    def add(self, grams: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct rows of numbers, equal first numbers together."""
        if not len(grams):
            return
        firsts = grams[:, 0]
        starts = np.r_[0, np.flatnonzero(np.diff(firsts)) + 1, len(grams)].tolist()
        rest = np.ascontiguousarray(grams[:, 1:].astype(">u4")).view(f"V{4 * (self.words - 1)}")[:, 0].tolist()
        counts = counts.tolist()
        for a, b in zip(starts, starts[1:]):
            self._below(int(firsts[a]), zip(rest[a:b], counts[a:b]))

    def _below(self, first: int, items) -> None:
        burst, tree = self.root.get(first, (False, {}))
        before = self.sizes.get(first, 0)
        size = before
        if burst:
            for key, n in items:
                box = tree.setdefault(key[:4], {})
                size += key[4:] not in box
                box[key[4:]] = box.get(key[4:], 0) + n
        else:
            for key, n in items:
                tree[key] = tree.get(key, 0) + n
            size = len(tree)
            if size > self.container and self.words > 2:
                branch: dict[bytes, dict[bytes, int]] = {}
                for key, n in tree.items():
                    branch.setdefault(key[:4], {})[key[4:]] = n
                burst, tree = True, branch
        self.root[first], self.sizes[first] = (burst, tree), size
        self.held += size - before

    def run(self, first: int) -> tuple[list[bytes], list[int]]:
        """What follows ``first``, in order, with its counts; the subtree is given up."""
        burst, tree = self.root.pop(first)
        self.held -= self.sizes.pop(first)
        if burst:
            tree = {second + key: n for second, box in tree.items() for key, n in box.items()}
        keys = sorted(tree)
        return keys, [tree[k] for k in keys]

    def spilled(self, down_to: int) -> tuple[np.ndarray, np.ndarray]:
        """(sequences, counts) of whole subtrees, the largest first, until ``down_to`` are left."""
        firsts, keys, counts = [], [], []
        for first in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.held <= down_to:
                break
            more, n = self.run(first)
            firsts.append((first, len(more)))
            keys += more
            counts += n
        head = np.repeat(np.array([f for f, _ in firsts], np.int64), [n for _, n in firsts])
        rest = np.frombuffer(b"".join(keys), ">u4").reshape(-1, self.words - 1).astype(np.int64)
        return np.column_stack([head, rest]) if len(head) else np.zeros((0, self.words), np.int64), np.array(counts, np.int64)


def distinct(codes: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct sequences of ``words`` codes from the places ``at`` on, their counts), in
    order of their codes."""
    if not len(at):
        return np.zeros((0, words), np.int64), np.zeros(0, np.int64)
    rank = np.unique(codes[at], return_inverse=True)[1]
    for k in range(1, words):
        _, first, rank, n = np.unique(rank.astype(np.int64) << 32 | codes[at + k], return_index=True, return_inverse=True, return_counts=True)
    return codes[at[first][:, None] + np.arange(words)], n


def counted_sequences(docs: DataFrame, words: int, dictionary, others, shorter, trie_sequences: int = TRIE_SEQUENCES) -> DataFrame:
    """(prefix, rest, n) of sequences of ``words`` words whose parts may be frequent.
    ``dictionary``, ``others`` and ``shorter`` (the map of sequences of one word less, null for
    pairs) are broadcast."""

    def count(batches):
        codes_of = Codes(dictionary.value, others.value if others else None)
        trie = HatTrie(words, trie_sequences)

        def rows(grams: np.ndarray, n: np.ndarray):
            for a in range(0, len(grams), 1 << 16):
                part = grams[a : a + (1 << 16)]
                split = min(words, PREFIX_WORDS)
                halves = []
                for half in (part[:, :split], part[:, split:]):
                    if half.shape[1] and (half >= OWN).any():
                        halves.append(pa.array(codes_of.written(half), pa.binary()))
                    else:
                        data = half.astype(">u4").tobytes()
                        offsets = np.arange(len(half) + 1, dtype=np.int32) * (4 * half.shape[1])
                        halves.append(pa.BinaryArray.from_buffers(pa.binary(), len(half), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
                yield pa.RecordBatch.from_arrays([*halves, pa.array(n[a : a + (1 << 16)], pa.int64())], ["prefix", "rest", "n"])

        for lang, texts in by_language(batches):
            found, piece = words_of(texts)
            if len(found) < words:
                continue
            codes = codes_of.of(lang, found.dictionary)[found.indices.to_numpy(zero_copy_only=False)]
            n = len(codes) - words + 1
            fits = piece[:n] == piece[words - 1 :]
            for k in range(words):
                fits &= codes[k : k + n] >= 0
            if shorter:
                frequent = passes(shorter.value, sequence_prints(codes_of.prints_of(codes), words - 1))
                fits &= frequent[:-1] & frequent[1:]
            trie.add(*distinct(codes, np.flatnonzero(fits), words))
            if trie.held > trie_sequences:
                yield from rows(*trie.spilled(trie_sequences // 2))
        yield from rows(*trie.spilled(0))

    made = docs.mapInArrow(count, "prefix binary, rest binary, n long")
    # Runs are distinct already: they meet by prefix without another sum before.
    return made.repartition("prefix").groupBy("prefix", "rest").agg(F.sum("n").alias("n"))


def named(sequences: DataFrame, names) -> DataFrame:
    """(lang, phrase, n, print) of written sequences."""

    def name(batches):
        for batch in batches:
            langs, phrases, prints = [], [], np.zeros(batch.num_rows, np.uint64)
            for k, (prefix, rest) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                lang, words, parts = read(prefix + rest, names.value)
                langs.append(lang)
                phrases.append(" ".join(words))
                one = np.array([word_prints([p])[0] if isinstance(p, bytes) else mixed_bits(np.array([p + 1], np.uint64))[0] for p in parts], np.uint64)
                prints[k] = sequence_prints(one, len(one))[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), batch.column(2), pa.array(prints.view(np.int64))], ["lang", "phrase", "n", "print"]
            )

    return sequences.mapInArrow(name, "lang string, phrase string, n long, print long")


def phrase_counts(
    docs: DataFrame, min_count: int, max_words: int, lang_col: str, text_col: str, dictionary_words: int, trie_sequences: int
) -> tuple[DataFrame, list[DataFrame]]:
    """(words of each language, per number of words the frequent phrases): tables of ``lang``,
    ``phrase``, ``n``."""
    spark = docs.sparkSession
    texts = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text"))
    words = stored(counted_words(texts), "words")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("total")), "word-totals")
    frequent = words.where(F.col("n") >= min_count)
    least = least_frequent(frequent, dictionary_words)
    held = frequent.where(F.col("n") >= least).select("lang", "phrase").toArrow().sort_by([("lang", "ascending"), ("phrase", "ascending")])
    langs, known = (held.column(c).combine_chunks() for c in ("lang", "phrase"))
    dictionary, at = {}, 0
    for run in langs.value_counts().to_pylist():  # in order of their first row, which is sorted
        dictionary[run["values"]] = (at, known.slice(at, run["counts"]))
        at += run["counts"]
    context = spark.sparkContext
    names = context.broadcast(list(zip(langs.to_pylist(), known.to_pylist())))
    rarer = frequent.where(F.col("n") < least)
    others = None
    if rarer.take(1):
        name = F.concat("lang", F.lit("\0"), "phrase")

        def prints(values: pa.Array) -> pa.Array:
            return pa.array(word_prints([OUTSIDE + len(v).to_bytes(4) + v for v in (x.encode() for x in values.to_pylist())]).view(np.int64))

        others = context.broadcast(bit_map(rarer.select(F.arrow_udf(prints, "long")(name).alias("print"))))
    sent = context.broadcast(dictionary)
    levels, shorter = [frequent.select("lang", "phrase", "n")], None
    for m in range(2, max_words + 1):
        found = counted_sequences(texts, m, sent, others, shorter, trie_sequences).where(F.col("n") >= min_count)
        found = stored(named(found, names), f"phrases-{m}")
        levels.append(found.select("lang", "phrase", "n"))
        if m < max_words:
            shorter = context.broadcast(bit_map(found))
    return totals, levels


def collocations(
    docs: DataFrame,
    min_count: int = 100,
    max_words: int = 5,
    top: int = 2000,
    covered_percent: int = 100,
    lang_col: str = "lang",
    text_col: str = "text",
    dictionary_words: int = DICTIONARY_WORDS,
    trie_sequences: int = TRIE_SEQUENCES,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``,
    ``n``, ``score``.

    A phrase is 2 to ``max_words`` words of one piece, found ``a >= min_count`` times. Of its cuts
    into a first part (found l times) and the rest (r) the one of lowest score
    ``floor(1000 * a * n / (l * r))`` counts, the first of equal ones; n is the words of the
    language. Phrases inside a longer one that is found ``covered_percent`` of their times
    are left out. Equal scores go by ``a``, then by the phrase's bytes.

    A null language is ``und``, a null or empty text has no words; rows that share an id or
    text all count; an empty table gives no row. Other columns are left out, whatever their
    names.
    """
    totals, levels = phrase_counts(docs, min_count, max_words, lang_col, text_col, dictionary_words, trie_sequences)
    counts, phrases = levels[0], None
    for level in levels[1:]:
        counts = counts.unionByName(level)
        phrases = level if phrases is None else phrases.unionByName(level)
    w = F.split("phrase", " ")

    def joined(first, size):
        return F.array_join(F.slice(w, first, size), " ")

    # What a longer phrase covers, its parts of one word less cover as well.
    ends = F.explode(F.array(joined(F.lit(1), F.size(w) - 1), joined(F.lit(2), F.size(w) - 1)))
    longer = phrases.where(F.size(w) > 2).select("lang", ends.alias("phrase"), F.col("n").alias("around"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    covered = F.coalesce(100 * F.col("around") >= covered_percent * F.col("n"), F.lit(False))
    alone = phrases.join(longer, ["lang", "phrase"], "left").where(~covered)
    cut = alone.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size(w) - 1)).alias("k"))
    cut = cut.select("*", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.size(w) - F.col("k")).alias("right"))
    cut = cut.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cut = cut.join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    # Products may pass 64 bits, the quotient is at most 1000 * n / min_count.
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    cut = cut.join(totals, "lang").withColumn("above", F.lit(1000).cast("decimal(38,0)") * wide("a") * wide("total")).withColumn("below", wide("l") * wide("r"))
    cut = cut.withColumn("score", F.expr("above div below"))
    best = cut.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "total", "score"), F.struct("score", "k")).alias("b")).select("lang", "phrase", "b.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    best = best.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
