import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from llm_fixtures import documents, empty, frame
from tokenizers import Tokenizer

from tabwatch.llm import packing
from tabwatch.llm.arrow import flat
import pyarrow as pa


def test_fill_finds_the_best_sum():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 90)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
        used = packing.fill(counts, room)
        assert sum(length * n for length, n in used.items()) == max(sums)
        assert all(n <= counts[length] for length, n in used.items())


def test_ids_are_the_tokenizers():
    tokenizer, ids_of = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)), packing.WordIds(packing.TOKENIZER)
    rng = random.Random(1)
    texts = [d[1] or "" for d in documents()] + ["J̌ don't <|STARTOFTEXT|> a<|endoftext|>b ×÷ ÿŸ Σς"]
    texts += ["".join(rng.choice("aZé,.'1 \n×ß<|>日́À\t0-") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    ids, starts = ids_of(*flat(pa.array(texts)))
    for k, text in enumerate(texts):
        assert ids[starts[k] : starts[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
    assert set(pieces) == set(texts)
    for doc, own in texts.items():
        wanted = []
        for text in own:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
            wanted.append((len(ids) // 4, ids))
        assert sum(r["length"] for r in pieces[doc]) == sum(n for n, _ in wanted)
        for r in pieces[doc]:
            a, b = 4 * r["start"], 4 * (r["start"] + r["length"])
            assert any(n == r["doc_tokens"] and zlib.crc32(ids[a:b]) == r["ids_crc32"] for n, ids in wanted)


def test_round_trip_without_padding(spark):
    texts = defaultdict(list)
    for d in documents():
        texts[d[0]].append(d[1])
    check(packing.pack(frame(spark)).collect(), texts, 2048)
    check(packing.pack(frame(spark), capacity=64).collect(), texts, 64)
    assert packing.pack(empty(spark)).count() == 0


def test_pool_stays_bounded(spark, monkeypatch):
    packer = packing.Packer(64, 0)
    rng = random.Random(3)
    for k in range(3000):
        packer.add(k, bytes(4 * rng.randint(1, 150)))
        if packer.waiting >= 50:
            packer.pack(25)
        assert packer.waiting <= 50
    packer.finish()
    assert sum(r[2] for r in packer.rows) == sum({r[0]: r[4] for r in packer.rows}.values())
