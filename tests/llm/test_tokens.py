import random

import numpy as np
import public_tokenizers
import sentencepiece

from callsift.llm import pieces, token_counts
from callsift.llm.token_counts import PieceCounter

BYTES = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  a  b ", "x\ty\nz", "été À la carte", "日本語 テキスト", "👍🏽 ok", "a▁b ▁▁c", "\x00\x1c\x85\xa0",
    "don't stop... now!!!", "word " * 3000, "unbroken" * 3000, " " * 700 + "end", "<s> </s> <0x41> <unk>", "é",
]


def greedy(word, start, inner):
    at, n, pieces_ = 0, 0, start
    while at < len(word):
        to = next((k for k in range(len(word), at, -1) if word[at:k] in pieces_), None)
        if to is None:
            return 1, True
        at, n, pieces_ = to, n + 1, inner
    return n, False


def test_counts_equal_greedy_longest_match():
    rng = random.Random(2)
    for _ in range(200):
        draw = lambda n: {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(n)}
        start, inner = draw(rng.randint(1, 9)), draw(rng.randint(0, 9))
        words = [bytes(rng.choice(b"abcd"[: rng.choice([3, 3, 4])]) for _ in range(rng.randint(1, 12))) for _ in range(60)]
        got, lost = PieceCounter(start, inner).count(words)
        assert list(zip(got.tolist(), lost.tolist(), strict=True)) == [greedy(w, start, inner) for w in words]


def test_texts_and_vocabulary_file(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    texts = [r["text"] for r in docs.limit(20).collect()] + [t for t in ODD]
    table = spark.createDataFrame([(k, t, 9) for k, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r["doc_id"]: r for r in token_counts.with_counts(table, BYTES).collect()}
    import json

    vocabulary = json.load(open(BYTES, encoding="utf-8"))["model"]["vocab"]
    alphabet = token_counts.byte_alphabet()
    space = chr(0x120)
    start = {bytes(alphabet[c] for c in t[1:]) for t in vocabulary if t[0] == space and set(t) <= set(alphabet)}
    inner = {bytes(alphabet[c] for c in t) for t in vocabulary if t[0] != space and set(t) <= set(alphabet)}
    for k, t in enumerate(texts):
        if t is not None and len(t) > 20_000:
            continue
        each = [greedy(w.encode(), start, inner) for w in token_counts.WORD.findall(t or "")]
        assert got[k]["n_words"] == len(each)
        assert (got[k]["n_tokens"], got[k]["n_unknown"]) == (sum(n for n, _ in each), sum(u for _, u in each))
    assert token_counts.with_counts(table.limit(0), BYTES).count() == 0


def best_score(text, score_of, unknown):
    marked = "▁" + text.replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        for start in range(max(0, end - 20), end):
            score = score_of.get(marked[start:end], unknown if end - start == 1 else float("-inf"))
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_segmentation_has_the_best_score():
    p = pieces.pieces_of(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    plain = [i for i in range(3, library.vocab_size()) if not library.is_byte(i)]
    score_of = {library.id_to_piece(i): library.get_score(i) for i in plain}
    rng = random.Random(4)
    for letters in ("abcdetion shé.,", "the and of ▁  日", "ab\n\x00 ü"):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(200)]
        for text, ids in zip(texts, p.encode(texts), strict=True):
            ids = ids.tolist()
            unknown = library.decode([i for i in ids if library.is_byte(i)])
            total = sum(p.score[i] for i in ids if not library.is_byte(i)) + len(unknown) * p.unknown
            assert abs(total - best_score(text, score_of, p.unknown)) < 1e-3, text
            assert p.decode(np.array(ids)) == text.replace("▁", " ") == library.decode(ids)


def test_round_trip_of_odd_texts(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(ODD)], "doc_id long, text string, ids string")
    rows = pieces.with_text(pieces.with_ids(docs, MODEL), MODEL).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")
    assert pieces.with_ids(docs.limit(0), MODEL).count() == 0
    assert len(pieces.pieces_of(MODEL).encode([""])[0]) == 0


def test_windows_and_few_long_words_give_the_same_ids(monkeypatch):
    p = pieces.Pieces(MODEL)
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdetion shé日") for _ in range(90)).replace(" ", "") for _ in range(40)]
    words = [w[:60] for w in words if len(w) >= 60]
    whole = p.segment(words)
    monkeypatch.setattr(pieces, "CELLS", 7 * len(words))
    assert p.segment(words) == whole  # windows of seven places
    monkeypatch.setattr(pieces, "CELLS", 7)
    assert [p.segment([w])[0] for w in words] == whole  # each alone, by the pieces that are there


def test_a_long_line_without_spaces_takes_bounded_memory():
    import resource

    p = pieces.Pieces(MODEL)
    rng = random.Random(7)
    line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789+/é") for _ in range(1000)) * 1000
    p.encode(["warm up"])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (ids,) = p.encode([line])
    grown = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before
    assert p.decode(ids) == line
    assert grown < 150_000  # KB, for a million characters


def test_known_words_are_bounded_in_bytes(monkeypatch):
    p = pieces.Pieces(MODEL)
    monkeypatch.setattr(pieces, "CACHED_BYTES", 20_000)
    for k in range(50):
        texts = [" ".join(f"w{k}x{j}" for j in range(50))]
        assert p.decode(p.encode(texts)[0]) == texts[0]
        assert len(p.known) < 250


def test_ids_keep_other_columns_and_null_ids(spark):
    docs = spark.createDataFrame(
        [(1, "a b", 5, [1, 2]), (2, None, None, None)], "doc_id long, text string, _source int, lists array<int>"
    )
    rows = {r["doc_id"]: r for r in pieces.with_ids(docs, MODEL, decoded="back").collect()}
    assert rows[1]["_source"] == 5 and rows[1]["lists"] == [1, 2] and rows[1]["back"] == "a b"
    assert rows[2]["ids"] == [] and rows[2]["back"] == "" and rows[2]["text"] is None
    back = {r["doc_id"]: r["text"] for r in pieces.with_text(docs, MODEL, "lists", "text").collect()}
    assert back[2] == "" and back[1] is not None


def test_counts_keep_a_column_of_their_helper_s_name(spark):
    docs = spark.createDataFrame([(1, "a word", 5, 6)], "doc_id long, text string, _t int, n_words int")
    row = token_counts.with_counts(docs, BYTES).first()
    assert row["_t"] == 5 and row["n_words"] == 2
