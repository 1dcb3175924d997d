"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import queries
from headway.llm.phrases import HatTrie, bit_map, collocations, distinct, passes, words_of

SCHEMA = "doc_id long, lang string, text string, phrase string, n string, a string"


def brute(rows, min_count, max_words, top, covered_percent=100):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = tuple(x for x in re.split("[ \t]", piece) if x)
            totals[lang or "und"] += len(w)
            for m in range(1, max_words + 1):
                counts.update((lang or "und", w[i : i + m]) for i in range(len(w) - m + 1))
    often = {k: n for k, n in counts.items() if n >= min_count and len(k[1]) > 1}
    covered = set()
    for (lang, w), n in often.items():
        for s in range(2, len(w)):
            for i in range(len(w) - s + 1):
                part = (lang, w[i : i + s])
                if 100 * n >= covered_percent * counts[part]:
                    covered.add(part)
    found = []
    for (lang, w), a in often.items():
        if (lang, w) not in covered:
            n = totals[lang]
            cuts = [(1000 * a * n // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.append((lang, -score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]], n))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n, -score))
    return out


def corpus():
    pick = random.Random(5)
    words = ["of", "the", "The", "New", "york", "City", "hall", "é", "東京", "\x01", "a\xa0b", "x'y"]
    rows = [(None, None), ("en", ""), ("en", " \t\n.."), ("de", "only once")]
    for k in range(300):
        text = "".join(pick.choice(words) + pick.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n"]) for _ in range(pick.randrange(60)))
        rows.append((pick.choice(["en", "de", None, "und"]), text + " new york city hall"))
    return rows


@pytest.mark.parametrize("dictionary_words, trie", [(1 << 20, 1 << 20), (3, 50), (0, 1 << 20)])
@pytest.mark.parametrize("covered", [100, 70])
def test_collocations(spark, dictionary_words, trie, covered):
    rows = corpus()
    docs = spark.createDataFrame([(1, *r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    got = collocations(docs, 5, 5, 40, covered, dictionary_words=dictionary_words, trie_sequences=trie)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 5, 40, covered)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert collocations(none).count() == 0
    assert collocations(spark.createDataFrame([(1, None, None, "", "", "")], SCHEMA)).count() == 0


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    got = queries.op11_hat_trie_phrases(spark, folder)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 100, 5, 2000)


@settings(deadline=None)
@given(st.lists(st.text(alphabet=" \tAb.\n,é東", max_size=12), max_size=5))
def test_words_and_pieces(texts):
    found, piece = words_of(pa.array(texts, pa.string()))
    want, where = [], []
    for t, text in enumerate(texts):
        for p, part in enumerate(re.split("[.,;:!?\n\x0b\x0c\r]", text.replace("A", "a"))):
            want += part.split()
            where += [(t, p)] * len(part.split())
    assert found.to_pylist() == want
    assert np.diff(piece).astype(bool).tolist() == [a != b for a, b in zip(where, where[1:])]


@settings(deadline=None)
@given(st.integers(2, 5), st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=4), st.integers(1, 6), st.integers(1, 6))
def test_trie_spills_what_it_counts(words, batches, most, container):
    trie, got, want = HatTrie(words, most, container), Counter(), Counter()
    runs = []
    for batch in batches:
        codes = np.array(batch, np.int64)
        at = np.arange(max(len(codes) - words + 1, 0))
        want.update(tuple(batch[i : i + words]) for i in at)
        trie.add(*distinct(codes, at, words))
        assert trie.held == sum(trie.sizes.values())
        if trie.held > most:
            runs.append(trie.spilled(most // 2))
            assert trie.held <= most // 2
    runs.append(trie.spilled(0))
    for grams, n in runs:
        got.update({tuple(g): 0 for g in grams.tolist()})
        for g, k in zip(grams.tolist(), n.tolist()):
            got[tuple(g)] += k
        inside = {}
        for g in map(tuple, grams.tolist()):  # each subtree is a sorted run
            assert inside.get(g[0], ()) < g
            inside[g[0]] = g
    assert +got == want and trie.held == 0


def test_map_holds_all_prints(spark):
    prints = np.random.default_rng(2).integers(-(2**63), 2**63, 500)
    bits = bit_map(spark.createDataFrame([(int(p),) for p in prints], "print long"))
    assert passes(bits, prints.view(np.uint64)).all()
    other = np.random.default_rng(3).integers(0, 2**63, 1000).astype(np.uint64)
    assert passes(bits, other).sum() < 5
