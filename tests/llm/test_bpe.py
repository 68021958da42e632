import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import op8_bpe as B


@pytest.fixture(scope="module")
def codec():
    return B.codec()


@pytest.fixture(scope="module")
def reference(codec):
    ranks = {t: i for i, t in enumerate(codec.vocabulary)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(codec, text):
    return np.frombuffer(b"".join(codec.encode(text)), "<u4").tolist()


def test_perfect_hash_is_minimal(codec):
    assert sorted(codec.hash(t) for t in codec.vocabulary) == list(range(len(codec.vocabulary)))
    assert codec.whole(b"\x00 not an entry") == -1


def test_blocks_and_memo(codec, reference, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 7)
    monkeypatch.setattr(B, "MEMO", 5)
    text = "Some words, 123 and <|endoftext|>  more\n\nwords; unbelievablywhatever " * 9
    assert ids_of(codec, text) == reference.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_as_the_library(codec, reference, text):
    assert ids_of(codec, text) == reference.encode_ordinary(text)


def test_long_runs(codec, reference):
    rng = random.Random(3)
    for text in ("a" * 4000, " " * 900 + "x", "".join(rng.choice("abc ") for _ in range(5000)), "".join(chr(rng.randrange(1, 0x3000)) for _ in range(2000))):
        assert ids_of(codec, text) == reference.encode_ordinary(text)


def test_frames(spark, make, texts, codec, reference):
    df = make(texts)
    rows = sorted(map(tuple, B.round_trip(df, codec).collect()), key=str)
    want = []
    for i, t in texts:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows == sorted(want, key=str)
    encoded = B.encode(df, codec)
    back = sorted(((r.doc_id, bytes(r.decoded).decode()) for r in B.decode(encoded, codec).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t in texts), key=str)
    assert B.round_trip(make([]), codec).count() == 0
