import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from brute import sha
from conftest import pairs
from tokenizers import Tokenizer

from usageledger.llm import bpe, tokencount
from usageledger.llm.bpe import merge_by_index
from usageledger.llm.tokencount import merge_by_rounds
from usageledger.llm.vocabulary import Encoder, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(3)
    alphabet = " \n\t\r  a's1é日՘!<|endoftext|>"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1_500)]
    return made + ["a" * 3_001, "ab" * 500, "  a   b  ", "a\n \n b", "<|endoftext|><|endoftext|>", "࢏ 𐡀 \x85 \x1c", "I'll we've 'S 's"]


@pytest.mark.parametrize("merge", [merge_by_index, merge_by_rounds])
def test_ids_equal_the_library(merge, library):
    texts = odd_texts()
    got = Encoder(vocabulary(PATH), merge).encode(texts)
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_memory_of_pieces_can_be_cleared(library, monkeypatch):
    encoder = Encoder(vocabulary(PATH), merge_by_rounds)
    monkeypatch.setattr(Encoder, "MAX_PIECES", 10)
    for text in ("some words here and there, and again", "other words <|endoftext|> here", "some words"):
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["documents", "odd_docs"])
def test_round_trip_digests(which, request, library):
    frame = request.getfixturevalue(which)
    want = []
    for i, text in pairs(frame):
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in bpe.digests(frame, PATH).collect())


def test_encode_decode_gives_ids_and_texts(documents, library):
    rows = bpe.encode_decode(documents.limit(20), PATH).collect()
    texts = dict(pairs(documents))
    assert all(r["decoded"] == texts[r["doc_id"]] and r["ids"] == library.encode(r["decoded"], add_special_tokens=False).ids for r in rows)


@pytest.mark.parametrize("which", ["documents", "odd_docs"])
def test_counts(which, request, library):
    frame = request.getfixturevalue(which)
    want = []
    for i, text in pairs(frame):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 512))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in tokencount.count_tokens(frame, PATH).collect())


def test_empty_tables(documents):
    assert bpe.digests(documents.limit(0), PATH).count() == 0
    assert tokencount.count_tokens(documents.limit(0), PATH).count() == 0
    assert len(merge_by_rounds(vocabulary(PATH), [])[0]) == 0 and len(merge_by_index(vocabulary(PATH), [])[0]) == 0


def test_decode_of_broken_sequences():
    vocab = vocabulary(PATH)
    assert vocab.decode(np.array([vocab.byte_id[0xC3]])) == "�"
