import hashlib
import random

import pytest

from wayline.llm import bpe_codec, token_counts
from wayline.llm.merges import read_byte_level, read_scored_pieces
from wayline.llm.queries import tokenizer_file

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")

PARTS = [
    "a", "b", " ", "  ", "\n", "\t", "é", "ß", "中", "🙂", "'s", "'ll", "1", "23", "!", "...", "the", "<|endoftext|>", "<s>", "</s>",
    "<0x41>", "\u00a0", "\x1c", "\u200b", "\x00", "aaaa", "\r\n", "Ġ", "▁", "ing", "tion", " " * 17, "ение", " {",
]


@pytest.fixture(scope="module")
def byte_level():
    return tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def scored():
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def texts(n):
    pick = random.Random(7)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 40))) for _ in range(n)]


def test_codec_equals_library(byte_level):
    own = bpe_codec.Codec(tokenizer_file("byte_bpe_50k.json"))
    for text in texts(3000):
        ids = own.encode(text)
        assert ids.tolist() == byte_level.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == byte_level.decode(ids.tolist(), skip_special_tokens=False)


def test_codec_forgets_without_harm(byte_level, monkeypatch):
    monkeypatch.setattr(bpe_codec, "REMEMBERED", 5)
    own = bpe_codec.Codec(tokenizer_file("byte_bpe_50k.json"))
    own.merges._limit = 20
    for text in texts(200):
        assert own.encode(text).tolist() == byte_level.encode(text, add_special_tokens=False).ids


def test_transducer_equals_library(scored):
    own = token_counts.Transducer(read_scored_pieces(tokenizer_file("piece_bpe_32k.model")))
    for text in texts(3000):
        assert own.count(text) == len(scored.encode(text))


def test_transducer_forgets_without_harm(scored, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 20)
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    own = token_counts.Transducer(read_scored_pieces(tokenizer_file("piece_bpe_32k.model")))
    for text in texts(300):
        assert own.count(text) == len(scored.encode(text))


def test_state_maps_compose(scored):
    own = token_counts.Transducer(read_scored_pieces(tokenizer_file("piece_bpe_32k.model")))
    for k, text in enumerate(t for t in texts(1500) if t):
        state, total, size = own.START, 0, 1 + k % 9
        for start in range(0, len(text), size):
            state, n = own.apply(state, *own.chunk_map(text[start : start + size], start == 0))
            total += n
        assert total == len(scored.encode(text))


def test_neighbours_are_compatible_as_merging_says():
    merges, _ = read_byte_level(tokenizer_file("byte_bpe_50k.json"))
    pick = random.Random(3)
    ids = [i for i, p in enumerate(merges.pieces) if p is not None and len(p) < 8]
    for _ in range(3000):
        a, b = pick.choice(ids), pick.choice(ids)
        left_alone = [t[0] for t in merges.merge(merges.pieces[a] + merges.pieces[b])] == [a, b]
        assert merges.compatible(a, b) == left_alone


def test_token_counts(odd_docs, empty_docs, scored):
    model = tokenizer_file("piece_bpe_32k.model")
    found = sorted((tuple(r) for r in token_counts.token_counts(odd_docs, model).collect()), key=repr)
    expected = [(r.doc_id, len((r.text or "").encode()), len(scored.encode(r.text or ""))) for r in odd_docs.collect()]
    assert found == sorted(expected, key=repr)
    assert token_counts.token_counts(empty_docs, model).collect() == []


def test_encode_decode(odd_docs, empty_docs, byte_level):
    file = tokenizer_file("byte_bpe_50k.json")
    found = sorted((tuple(r) for r in bpe_codec.digests(bpe_codec.encode_decode(odd_docs, file)).collect()), key=repr)
    expected = []
    for r in odd_docs.collect():
        ids = byte_level.encode(r.text or "", add_special_tokens=False).ids
        decoded = byte_level.decode(ids, skip_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    assert found == sorted(expected, key=repr)
    assert bpe_codec.encode_decode(empty_docs, file).collect() == []
