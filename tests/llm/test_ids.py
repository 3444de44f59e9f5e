"""Ids beyond 2**53 next to rows without an id keep every digit, and so do the folds that follow from them."""

import base64
import json
import random
import zlib

import pytest

from lakeweir.llm import (
    decontamination,
    language_model,
    near_dedup,
    quality,
    secret_scan,
    token_files,
    toxicity,
)

IDS = [2**53 + 1, 2**53 + 3, 2**60 + 7, -(2**61) - 1, None, 12]


@pytest.fixture(scope="module")
def docs(spark):
    dice = random.Random(9)
    words = ["".join(dice.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    rows = [(i, " ".join(dice.sample(words, 60))) for i in IDS]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=repr)


def test_ids_keep_all_digits(spark, docs):
    want = sorted(IDS, key=repr)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(2**53 + 5, docs.where("doc_id = 12").first().text)], "item_id long, text string")
    assert ids(secret_scan.scan_secrets(docs)) == want
    for module, score in ((toxicity, toxicity.score_toxicity), (quality, quality.score_quality)):
        got = score(docs, module.train(docs, labels))
        assert ids(got) == want
        for row in got.collect():
            held = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % module.FOLDS == module.HELD_OUT
            assert row.held_out == held
    got = language_model.score_texts(docs)
    assert ids(got) == want
    for row in got.collect():
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 2)
    assert ids(near_dedup.near_duplicates(docs)) == want
    found = decontamination.find_contamination(docs, bench).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(12, 2**53 + 5)]
    import public_tokenizers

    assert ids(token_files.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))) == want


def test_no_document_is_lost_beside_one_without_id(spark):
    dice = random.Random(3)
    rows = [(None if i == 7 else 2**55 + i, " ".join(f"w{dice.randrange(10**9)}" for _ in range(40))) for i in range(41)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert near_dedup.keep_one_of_each(docs).count() == 41


def test_session_settings_stay(spark, docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    toxicity.keep_harmless(docs, toxicity.train(docs, labels)).count()
    near_dedup.near_duplicates(docs).count()
    language_model.score_texts(docs).count()
    assert spark.conf.get(key) == before


def test_one_id_with_many_rows_is_one_training_row(spark):
    rows = [(0, f"text number {i} of one id") for i in range(3000)] + [(i, f"another {i}") for i in range(1, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    from pyspark.sql import functions as F

    from lakeweir.llm.labelled import one_per_id

    assert one_per_id(docs.join(labels.withColumn("label", F.col("toxic")), "doc_id").select("doc_id", "text", "label")).count() == 40
    toxicity.train(docs, labels, 50)
    quality.train(docs, labels, 50)


def test_long_runs_and_structures_of_secrets():
    part = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
    token = lambda alg, n: ".".join([part(json.dumps({"alg": alg}).encode()), part(b'{"a":1}'), part(bytes(n))])
    kind = lambda text: [k for _, k, _ in secret_scan.structural_spans(text)]
    assert secret_scan.structural_spans("longword.xx." + token("HS256", 32)) == [(12, 5, 12 + len(token("HS256", 32)))]
    assert kind(token("ES256K", 64)) == kind(token("EdDSA", 114)) == [5] and kind(token("EdDSA", 65)) == []
    assert kind(token("HS256", 32) + "." + token("HS384", 48)) == [5, 5]
    der = lambda tag, body: bytes([tag, 0x82]) + len(body).to_bytes(2, "big") + body
    small = lambda body: bytes([2, len(body)]) + body
    rsa = der(0x30, small(b"\0") + b"".join(small(bytes([k + 1] * 40)) for k in range(8)))
    lines = base64.encodebytes(rsa).decode()
    armored = f"-----BEGIN RSA PRIVATE KEY-----\n{lines}-----END RSA PRIVATE KEY-----"
    assert kind(armored) == [3] and kind(json.dumps({"key": armored})) == [3]
    assert kind(base64.b64encode(armored.encode()).decode()) == [3]
    body = base64.encodebytes(bytes(range(128))).decode()
    for headers, want in (("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,ABCDEF0123456789\n\n", [3]), ("", [])):
        assert kind(f"-----BEGIN RSA PRIVATE KEY-----\n{headers}{body}-----END RSA PRIVATE KEY-----") == want
    import time

    start = time.perf_counter()
    for text in ("a" * 400_000 + " x.y", "a." * 200_000, ("eyJh" * 10 + ".") * 10_000, "-----BEGIN PRIVATE KEY-----\nab" * 10_000):
        secret_scan.structural_spans(text)
    assert time.perf_counter() - start < 10


def test_equal_rows_are_permuted_too(spark):
    from lakeweir.llm import sharding

    rows = [(7, "the very same")] * 1001 + [(100 + i, f"text {i}") for i in range(2999)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for placed in (sharding.assign_shards(docs), sharding.shard_documents(docs)):
        got = placed.select("doc_id", "shard", "slot").collect()
        assert len(got) == 4000
        by_shard = {}
        for r in got:
            by_shard.setdefault(r.shard, []).append((r.slot, r.doc_id == 7))
        for found in by_shard.values():
            assert sorted(s for s, _ in found) == list(range(500))
            same = sorted(s for s, mine in found if mine)
            # 1,001 of 4,000 rows: about 125 a shard (10 more or less), spread over its slots.
            assert 80 < len(same) < 170
            runs = 1 + sum(b != a + 1 for a, b in zip(same, same[1:]))
            assert runs > 60
    again = [{(r.doc_id, r.shard, r.slot) for r in sharding.assign_shards(d).collect()} for d in (docs, docs.coalesce(1))]
    assert again[0] == again[1]


@pytest.mark.parametrize("size", [25, 400])
def test_contamination_of_frequent_words_is_all_that_alignment_finds(size):
    """Words of natural frequencies, copies with edits: every pair above the threshold with two words in a row, none else."""
    import numpy as np

    from lakeweir.llm.common import words_of

    dice, rng = random.Random(size), np.random.default_rng(size)
    share = 1 / np.arange(1, size + 1)
    draw = lambda n: [f"w{k}" for k in rng.choice(size, n, p=share / share.sum())]
    texts = [" ".join(draw(dice.choice([2, 4, 8, 15, 30]))) for _ in range(25)]
    docs = []
    for _ in range(12):
        body = draw(dice.choice([0, 20, 120]))
        copy = dice.choice(texts).split()
        every = dice.choice([2, 3, 5, 100])
        edited = [x for k, w in enumerate(copy) for x in ([w] if k % every else dice.choice([["zz"], [], [w, *draw(2)]]))]
        docs.append(" ".join([*body, *edited, *draw(5)]))
    items = decontamination.items_of(list(enumerate(texts)))
    found = {(k, m[0]): m[1] for k, ms in decontamination.Matcher(items, 0.5).search(docs) for m in ms}
    for k, doc in enumerate(docs):
        words = words_of([doc]).of(0)
        for item in items:
            score, *_ = decontamination.align(item.words, words)
            best = score / (decontamination.MATCH * len(item.words))
            if (k, item.item_id) in found:
                assert abs(found[k, item.item_id] - best) < 1e-12
            else:
                # What two words in a row are asked for may be missing just at the threshold.
                assert best <= 0.5 + 1 / (2 * len(item.words))


def test_of_rows_with_one_id_the_same_stays(spark):
    rows = [(5, f"text number {k} of this id with some words of its own {k * 7}", f"s{k}") for k in range(6)]
    docs = spark.createDataFrame(rows + [(6, None, "x"), (6, "", "y"), (None, "a", "z")], "doc_id long, text string, source string")
    kept = [
        sorted((tuple(r) for r in near_dedup.keep_one_of_each(d).collect()), key=repr)
        for d in (docs, docs.repartition(5), docs.orderBy(docs.source.desc()).coalesce(1))
    ]
    assert [r[0] for r in kept[0]] == [5, 6, None] and kept[0][0] == kept[1][0] == kept[2][0]
