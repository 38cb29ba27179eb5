import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from callsift.llm import packing
from callsift.llm.packing import Costs

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "a" * 5000, "Hello, World! It's 3.5 o'clock.", "<|endoftext|> x<|startoftext|>y",
    "İstanbul ΣΑΣ İ", "été 가", "日本語のテキスト。　次", "x\x85y\xa0z\x1cw\x1f v",
    "½² ª ŉ ſ ĸ", "don't we'll they've I'm", "​‍👍🏽 ok", "A\tB\nC\x0bD\x0cE\rF", "...!!! ###$$$ %%%",
]


def test_ids_equal_the_tokenizers():
    texts = [t or "" for t in ODD]
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])
    texts += table["text"].to_pylist()
    got = packing.encoder(PATH).encode(pa.array(texts))
    whole = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    for ids, want in zip(got, whole, strict=True):
        assert ids.tolist() == want.ids


def brute(pos, penalty, costs):
    best = [0.0] + [float("inf")] * (len(pos) - 1)
    for j in range(1, len(pos)):
        for i in range(j):
            n = pos[j] - pos[i]
            if n <= costs.size:
                pad = 0 if n & (n - 1) == 0 else costs.size - n
                best[j] = min(best[j], best[i] + pad + penalty[j] + costs.open_cost)
    return best[-1]


def test_cuts_cost_the_least():
    rng = random.Random(3)
    for _ in range(60):
        costs = Costs(size=32, shortest=1, open_cost=rng.choice([0, 2]))
        pos = np.cumsum([0] + [rng.randint(1, 12) for _ in range(rng.randint(1, 60))])
        penalty = np.array([rng.choice([0.0, 4.0, 24.0]) for _ in pos])
        cuts = packing.cut_positions(pos, penalty, costs)
        got = 0.0
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            n = int(pos[j] - pos[i])
            got += (0 if n & (n - 1) == 0 else 32 - n) + penalty[j] + costs.open_cost
        assert cuts[0] == 0 and cuts[-1] == len(pos) - 1
        assert abs(got - brute(pos.tolist(), penalty.tolist(), costs)) < 1e-6


def test_pieces_hold_every_id_once(spark):
    texts = ODD + ["One sentence here. Another one! " * 400, "nopunctuation " * 9000] + ODD
    rows = [(None if k == 3 else k % 20, t, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string").coalesce(1)
    got = packing.pack(docs, PATH, Costs(block=6000)).collect()
    whole = Tokenizer.from_file(PATH)
    wanted = [whole.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    stream = [i for ids in wanted for i in ids]
    seen = [i for r in got for i in np.frombuffer(bytes(r["tokens"]), "<u4").tolist()]
    assert seen == stream
    filled = {}
    for r in got:
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
        assert r["length"] == len(r["tokens"]) // 4 <= r["doc_tokens"] - r["start"]
    assert max(filled.values()) <= 4096
    loss = sum(4096 - n for n in filled.values() if n & (n - 1))
    assert loss < 4096 + 30 * len(filled)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, PATH).count() == 0
    assert zlib.crc32(np.array([2], "<u4").tobytes()) > 0
