"""The pipeline's stages on a small corpus."""

import base64
import hashlib
import random
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from framesieve.llm import bpe, mixing, quality
from tests.llm.test_operators import brute_components, documents, prose


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(20)
    texts = [prose(rng, 80) for _ in range(120)]
    texts += [" ".join(w.upper() + "!!" for w in prose(rng, 80).split()) for _ in range(60)]
    texts += [texts[0], texts[1] + " end", "\n".join([prose(rng, 20) for _ in range(3)]), None, ""]
    texts.append("fresh line\n" + texts[182])
    path = tmp_path_factory.mktemp("sf")
    docs = documents(spark, texts, [f"s{i % 4}" for i in range(len(texts))])
    docs.write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(180)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path), texts


def test_each_stage_keeps_the_columns_and_takes_effect(spark, corpus):
    path, texts = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    after = stages["quality classifier"](spark, docs, path).cache()
    ids = {r["doc_id"] for r in after.collect()}
    assert set(range(120)) <= ids and not ids & set(range(120, 180)) and after.columns == docs.columns
    clean = stages["line dedup"](spark, after, path).cache()
    by = {r["doc_id"]: r for r in clean.collect()}
    assert by[185]["text"] == "fresh line" and by[185]["n_chars"] == 10 and clean.columns == docs.columns
    single = stages["near-duplicate removal"](spark, clean, path).cache()
    left = {r["doc_id"] for r in single.collect()}
    assert 180 not in left and 181 not in left and {0, 1} <= left and single.columns == docs.columns
    mixed = stages["source mixing"](spark, single, path)
    assert mixed.columns == docs.columns and mixed.count() >= 1


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, score string, n_lines string, rep string, copies string, ids string, labels string"


def awkward(spark, texts):
    """Null ids, texts, languages and sources, empty and very long texts, repeated rows, further columns of clashing names."""
    rng = random.Random(25)
    base = prose(rng, 90).split()
    near = [" ".join(base[:40] + [f"new{i}"] + base[41:]) for i in range(3)]
    lines = "\n".join(prose(rng, 9) for _ in range(5))
    every = [*texts[:40], *texts[120:130], " ".join(base), *near, lines, "own line\n" + lines, None, "", "  ", "word " * 30_000]
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(every)]
    rows += [rows[0], rows[0], rows[-4], (None, "text without an id", None, None, 18), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], AWKWARD)


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect())


def test_each_stage_equals_brute_force_on_awkward_rows(spark, corpus):
    path, texts = corpus
    docs = awkward(spark, texts)
    stages = dict(corpus_pipeline.STAGES)
    plain = rows_of(docs)

    got = stages["quality classifier"](spark, docs, path)
    assert tuple(got.columns) == corpus_pipeline.COLUMNS
    labels = spark.read.parquet(f"{path}/labels.parquet").where("crc32(cast(doc_id as string)) % 5 <> 0")
    scorer = quality.fit_quality(docs, labels).scorer()
    want = Counter({r: n for r, n in plain.items() if scorer.score(r[1]) >= 0.3})
    assert rows_of(got) == want and 0 < len(want) < len(plain)

    got = rows_of(stages["line dedup"](spark, docs, path))
    first, gone = {}, defaultdict(set)
    for at, r in enumerate(sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0))):
        split = (r[1] or "").split("\n")
        for p in range(len(split) - 2):
            begin = first.setdefault(tuple(split[p : p + 3]), (at, p))
            if begin != (at, p):
                gone[r] |= set(range(max(p, begin[1] + 3) if begin[0] == at else p, p + 3))
    want = Counter()
    for r, n in plain.items():
        left = [x for p, x in enumerate((r[1] or "").split("\n")) if p not in gone[r]]
        if left:
            want[r if not gone[r] else (r[0], "\n".join(left), r[2], r[3], len("\n".join(left)))] += n
    assert got == want and any(gone.values())

    got = rows_of(stages["near-duplicate removal"](spark, docs, path))
    known = sorted((r for r in plain if r[0] is not None), key=lambda r: r[0])
    groups = brute_components([r[1] for r in known], 5, 80)
    kept = {r[0] for i, r in enumerate(known) if groups[i][1] == i}
    assert got == Counter({r: n for r, n in plain.items() if r[0] is None or r[0] in kept}) and len(kept) < len(known)

    got = rows_of(stages["source mixing"](spark, docs, path))
    most = defaultdict(int)
    for r in mixing.weighted_fair_mix(docs).collect():
        most[r["doc_id"]] = max(most[r["doc_id"]], r["copies"])
    assert got == Counter({r: n * most[r[0]] for r, n in plain.items() if most[r[0]]}) and sum(got.values()) > 0

    got = stages["byte-level BPE"](spark, docs, path)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    want = Counter()
    for r, n in plain.items():
        ids = encoding.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += n
    assert Counter(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want


def ranks():
    raw = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


def test_run_applies_the_stages_one_after_the_other(spark, corpus):
    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame((out := stage(spark, docs, path)).collect(), out.schema)
    assert Counter(map(tuple, corpus_pipeline.run(spark, path).collect())) == Counter(map(tuple, docs.collect()))


def test_run_gives_digests(spark, corpus):
    path, texts = corpus
    rows = corpus_pipeline.run(spark, path).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert len({r["doc_id"] for r in rows} & set(range(120, 180))) == 0


def test_stages_take_empty_tables(spark, corpus):
    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0
