"""What the operators share: stored steps, packed rows, words, tokens."""

from __future__ import annotations

import ctypes
import json
import re
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "row"
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only a local master, where one machine is all there is, gets a folder of its own
    when the setting is absent.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="headway-llm-")
    return _own_folders[context.applicationId]


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it from there.

    Cuts the lineage, so a lost executor costs no more than the step at hand, and
    later readers fetch only the columns they use.
    """
    path = f"{shared_folder(df.sparkSession)}/headway-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """The whole input row as one struct, so that no column of it can clash with
    a column an operator adds for itself."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW)


def unpacked(df: DataFrame, names: list[str], results: list[str]) -> DataFrame:
    """Input columns again, then ``results``; a result replaces an input column of
    the same name."""
    old = [F.col(ROW)[c].alias(c) for c in names if c not in results]
    return df.select(*old, *results)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]`` in order."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), "")


def least_frequent(counts: DataFrame, most: int) -> int:
    """A value of ``n`` that no more than ``most`` rows reach, the smallest among the bounds
    of classes (four leading bits); only class sizes reach the driver."""
    bound = F.expr("shiftleft(shiftright(n, greatest(length(bin(n)) - 4, 0)), greatest(length(bin(n)) - 4, 0))")
    classes = counts.groupBy(bound.alias("bound")).agg(F.count("*").alias("rows")).collect()
    least, total = max((c["bound"] for c in classes), default=0) * 2 + 1, 0
    for c in sorted(classes, reverse=True):
        total += c["rows"]
        if total > most:
            break
        least = c["bound"]
    return least


# Letters of one word that stay letters, one for one, in any normal form and case, and
# marks that make a word of their own behind them.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"\-.,!?;:|%&#*$@()/=+_~^"


# White space besides space, tab and line ends, and bytes that no usual text holds.
RARE = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


# Bytes that are ASCII letters.
LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(where each text begins and the last ends, bytes of all) of texts without null."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def cut_at(starts: np.ndarray, data: np.ndarray) -> pa.Array:
    """Strings between consecutive ``starts`` (the last one is the end)."""
    return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def units(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(units before each text and after the last, all units) of texts without null: a word
    with the space before it, marks behind letters, or what else of white space stands between. A byte-level
    vocabulary never joins over their bounds."""
    bounds, data = raw(texts)
    if not len(data):
        return np.zeros(len(texts) + 1, np.int64), pa.array([], pa.string())
    blank = (data == 32) | (data == 9) | (data == 10) | (data == 13)
    opens = np.zeros(len(data) + 1, bool)
    opens[bounds] = True
    follows = ~opens[:-1]  # has a byte of its text before it
    after = np.r_[False, blank[:-1]]
    word_next = np.r_[~blank[1:], False] & ~opens[1:]
    spaced = np.r_[False, data[:-1] == 32]
    letter = LETTER[data]
    mark = ~(letter | blank) & (data > 32) & (data < 127) & ~((data >= 48) & (data <= 57))
    marked = mark & np.r_[False, letter[:-1]]
    opens[:-1] |= follows & ((blank & (~after | word_next)) | (~blank & after & ~spaced) | marked)
    starts = np.flatnonzero(opens)
    return np.searchsorted(starts, bounds), cut_at(starts, data)


def gathered(index: np.ndarray, bounds: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, pool: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids per text, all ids) of texts made of parts ``index[bounds[k]:bounds[k + 1]]``, part p
    having ``sizes[p]`` ids in the pool from ``firsts[p]`` on."""
    each = sizes[index]
    ends = np.cumsum(each)
    at = np.repeat(firsts[index] - (ends - each), each)
    at += np.arange(len(at))
    return np.diff(np.r_[0, ends][bounds]), pool[at]


# Words that an encoder remembers with their ids, and bytes of the longest of them.
KNOWN_WORDS, KNOWN_LENGTH = 1 << 17, 64


class Encoder:
    """Token ids of texts by a tokenizers file; with ``plain``, the strings of special tokens
    are ordinary text.

    For a plain byte-level vocabulary the distinct units (see ``units``) of a batch are
    encoded, those with a space in one go; texts with rare white space, control characters or
    special tokens go whole.

    For a lower-case byte-level vocabulary with end-of-word marks, white space only
    separates words and the ids of a text are those of its words in order. Then the
    distinct words of a batch are encoded: letters with or without marks behind, nearly
    all, go through the vocabulary's model in one go, the rest one by one through the whole
    tokenizer. The first KNOWN_WORDS words met are remembered and not encoded again in later
    batches. Other vocabularies get the whole texts.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        config = json.loads(self.tokenizer.to_str())
        suffix = config["model"].get("end_of_word_suffix")
        steps = json.dumps([config["normalizer"], config["pre_tokenizer"]])
        self.ends = self.spaced = None
        before = config["pre_tokenizer"] or {}
        if config["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]:
            self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.spaced[[i for w, i in self.tokenizer.get_vocab().items() if w.startswith("Ġ")]] = True
            names = [] if plain else [re.escape(t["content"]) for t in config["added_tokens"]]
            self.whole = "|".join([RARE, *names])
        if suffix and '"Lowercase"' in steps and '"ByteLevel"' in steps:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for w, i in self.tokenizer.get_vocab().items() if w.endswith(suffix)]] = True
            self.known, self.known_ids = pa.array([], pa.string()), np.zeros(0, np.uint32)
            self.known_firsts = self.known_sizes = np.zeros(0, np.int64)
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            # Each letter as the two characters that stand for its bytes, none of them a letter
            # replaced here.
            letters = [chr(c) for c in range(0xDF, 0x100)]
            self.bytes = [(c, level.pre_tokenize_str(c)[0][0]) for c in letters]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first id, number of ids) of each word in the pool of ids, and the pool."""
        usual = pc.match_substring_regex(words, f"^[{LETTERS}]+[{MARKS}]*$")
        some = words.filter(usual)
        spaced = pc.replace_substring_regex(some, f"([{MARKS}]+)$", r" \1")
        line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), spaced), " ")[0].as_py()
        line = line.lower()
        if not line.isascii():
            for letter, two in self.bytes:
                line = line.replace(letter, two)
        pool = np.array(self.model.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
        parts = 1 + np.asarray(pc.match_substring_regex(some, f"[{MARKS}]$"), np.int64)
        ends = np.flatnonzero(self.ends[pool]) + 1
        if len(ends) != parts.sum():
            raise ValueError("the vocabulary ends words elsewhere than expected")
        stops = ends[np.cumsum(parts) - 1]
        other = self._ids(words.filter(pc.invert(usual)).to_pylist()) if len(some) < len(words) else []
        mask = np.asarray(usual, bool)
        sizes = np.empty(len(words), np.int64)
        sizes[mask] = np.diff(stops, prepend=0)
        sizes[~mask] = [len(x) for x in other]
        firsts = np.empty(len(words), np.int64)
        firsts[mask] = np.r_[0, stops[:-1]] if len(stops) else stops
        firsts[~mask] = len(pool) + np.cumsum(sizes[~mask]) - sizes[~mask]
        return firsts, sizes, np.concatenate([pool, *other])

    def _remembered(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_words``, encoding only what is not known yet."""
        at = pc.index_in(words, value_set=self.known)
        new = np.asarray(pc.is_null(at), bool)
        fresh, old = words.filter(pa.array(new)), np.asarray(pc.drop_null(at), np.int64)
        firsts, sizes = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        firsts[~new], sizes[~new] = self.known_firsts[old], self.known_sizes[old]
        if not len(fresh):
            return firsts, sizes, self.known_ids
        found, counts, ids = self._words(fresh)
        firsts[new], sizes[new] = len(self.known_ids) + found, counts
        pool = np.concatenate([self.known_ids, ids])
        short = np.flatnonzero(np.asarray(pc.binary_length(fresh)) <= KNOWN_LENGTH)[: max(0, KNOWN_WORDS - len(self.known))]
        if len(short):
            more = gathered(short, np.array([0, len(short)]), found, counts, ids)[1]
            begins = len(self.known_ids) + np.cumsum(counts[short]) - counts[short]
            self.known = pa.concat_arrays([self.known, fresh.take(pa.array(short))])
            self.known_firsts = np.r_[self.known_firsts, begins]
            self.known_sizes = np.r_[self.known_sizes, counts[short]]
            self.known_ids = np.concatenate([self.known_ids, more])
        return firsts, sizes, pool

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first id, number of ids) of each distinct unit in the pool of ids, and the pool."""
        mask = np.asarray(pc.match_substring_regex(units, "^ [^ \\t\\r\\n]"), bool)
        line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, int(mask.sum())], pa.int32()), units.filter(pa.array(mask))), "")[0].as_py()
        pool = self._ids([line])[0]
        starts = np.flatnonzero(self.spaced[pool])
        if len(starts) != mask.sum():
            raise ValueError("the vocabulary begins words elsewhere than expected")
        other = self._ids(units.filter(pa.array(~mask)).to_pylist())
        sizes = np.empty(len(units), np.int64)
        sizes[mask] = np.diff(starts, append=len(pool))
        sizes[~mask] = [len(x) for x in other]
        firsts = np.empty(len(units), np.int64)
        firsts[mask] = starts
        firsts[~mask] = len(pool) + np.cumsum(sizes[~mask]) - sizes[~mask]
        return firsts, sizes, np.concatenate([pool, *other])

    def _by_units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = np.asarray(pc.match_substring_regex(texts, self.whole), bool)
        if not whole.any():
            before, found = units(texts)
            coded = found.dictionary_encode()
            return gathered(coded.indices.to_numpy(zero_copy_only=False), before, *self._units(coded.dictionary))
        counts = np.zeros(len(texts), np.int64)
        counts[~whole], most = self._by_units(texts.filter(pa.array(~whole)))
        rest = self._ids(texts.filter(pa.array(whole)).to_pylist())
        counts[whole] = [len(x) for x in rest]
        ids = np.empty(counts.sum(), np.uint32)
        mine = np.repeat(whole, counts)
        ids[~mine], ids[mine] = most, np.concatenate([*rest, np.zeros(0, np.uint32)])
        return counts, ids

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids in order); a null text has none."""
        texts = pc.fill_null(texts, "")
        if self.spaced is not None:
            return self._by_units(texts)
        if self.ends is None:
            found = self._ids(texts.to_pylist())
            return np.array([len(x) for x in found], np.int64), np.concatenate([*found, np.zeros(0, np.uint32)])
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        return gathered(coded.indices.to_numpy(zero_copy_only=False), lists.offsets.to_numpy(), *self._remembered(coded.dictionary))


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder for each file in each Python worker, kept from task to task."""
    return Encoder(path, plain)


def give_back() -> None:
    """Return memory that is free but still held by this process to the system.

    A Python worker serves task after task and step after step; what the allocators keep of
    one step would add to all that the executor holds in the next.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every system's library has it
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about 4 MB, not of 10,000 rows, so that neither an
    executor's buffers nor a worker hold more, however long the texts are.

    The setting stays with the session: what an operator returns runs later. It counts
    bytes, so short rows still go 10,000 at a time.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def slices(batch: pa.RecordBatch, rows: int = 2500, size: int = 1 << 24):
    """Parts of at most ``rows`` rows and about ``size`` bytes of text, however long one text
    is, so that what a task holds at once stays small; afterwards free memory is given back."""
    if not batch.num_rows:
        return
    weight = np.full(batch.num_rows, -(-size // rows), np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            weight += np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(weight) // size)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)
    give_back()
