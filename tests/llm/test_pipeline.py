"""The stages of the pipeline against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from headway.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, found string, doc string, kept string"
STAGE = dict(corpus_pipeline.STAGES)
EN = "the house with thing and of that have been where which would there people".split()
DE = "das Haus nicht schön und der für über werden Straße können möchte auch noch".split()


def prose(words, n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) + (pick.choice(EN) if pick.random() < 0.3 else "") for _ in range(n))


def documents():
    rows = [(k, prose(EN if k % 3 else DE, 40 + k % 50, k), "en" if k % 3 else "de", f"s{k % 4}") for k in range(120)]
    base = rows[7][1].split()
    rows += [(200, rows[5][1], "en", "s1"), (201, "  ".join(rows[5][1].split(" ")), "en", "s2"), (202, " ".join([*base[:-1], "other"]), "en", "s1")]
    rows += [(203, " ".join(["more", *base]), "en", None), (None, rows[9][1] + " tail", "en", "s1"), (300, None, None, "s1"), (301, "", "en", None), (302, "123 456", "en", "s0")]
    rows += [(400, prose(EN, 60, 999), "en", "s1"), (400, prose(EN, 60, 999) + " one", "en", "s1"), (None, prose(EN, 70, 998), "en", "s3"), (None, prose(EN, 70, 998) + " one", "en", "s3")]
    return [(*r, len(r[1] or ""), "f", "d", "k") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


def texts(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def run(spark, name, frame):
    made = STAGE[name](spark, frame, "")
    assert made.columns == frame.columns or name == corpus_pipeline.STAGES[-1][0]
    return made


def shingles(text, width=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, min(len(w), 1)))}


def test_language_keeps_clean_documents(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    kept = texts(run(spark, names[0], docs))
    assert not any((t or "").strip() == "" or t == "123 456" for _, t in kept)
    clean = [(r[0], r[1]) for r in documents()[:120]]
    assert sum(kept[c] == 1 for c in clean) >= 0.95 * len(clean)


def test_exact_copies_keep_one_of_each_text(spark, docs):
    got = texts(run(spark, corpus_pipeline.STAGES[1][0], docs))
    groups = defaultdict(list)
    for r in documents():
        groups[" ".join((r[1] or "").split(" ")) if not (r[1] or "").strip() else " ".join(r[1].split())].append((r[0], r[1]))
    want = Counter(min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups.values())
    assert Counter({(d, " ".join((t or "").split())): n for (d, t), n in got.items()}) == Counter({(d, " ".join((t or "").split())): n for (d, t), n in want.items()})


def test_near_copies_keep_one_of_each_group(spark, docs):
    once = run(spark, corpus_pipeline.STAGES[1][0], docs)
    rows = [(r.doc_id, r.text) for r in once.collect()]
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for k, row in enumerate(rows):
        groups[root(k)].append(row)
    got = texts(run(spark, corpus_pipeline.STAGES[2][0], once))
    assert sum(got.values()) == len(groups) < len(rows)
    for group in groups.values():
        ids = [d for d, _ in group if d is not None]
        inside = [k for k in got if k in group]
        assert len(inside) == 1 and inside[0][0] == (min(ids) if ids else None)


def test_mix_and_packing(spark, docs):
    mixed = run(spark, corpus_pipeline.STAGES[3][0], docs)
    given, copies = texts(docs), texts(mixed)
    assert set(copies) <= set(given) and all(n <= 3 * given[k] for k, n in copies.items())
    packed = run(spark, corpus_pipeline.STAGES[4][0], mixed).collect()
    tokenizer = Tokenizer.from_file(queries.word_vocabulary())
    tokens = sum(n * (len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for (_, t), n in copies.items())
    fill = defaultdict(int)
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert fill[r.sequence_id] == r.offset
        fill[r.sequence_id] += r.length
    assert sum(fill.values()) == tokens and max(fill.values()) <= 2048


def test_empty_table(spark, docs):
    frame = docs.where("doc_id = -5")
    for name, _ in corpus_pipeline.STAGES:
        frame = run(spark, name, frame)
        assert frame.count() == 0
        if "text" in frame.columns:
            frame = spark.createDataFrame([], frame.schema)


def test_stages_follow_each_other(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.count() > 0 and done.agg(F.sum("length")).first()[0] > 1000
    assert np.all([r.offset >= 0 for r in done.select("offset").collect()])
