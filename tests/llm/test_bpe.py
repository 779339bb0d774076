import numpy as np
import public_tokenizers
import pytest
from cases import ODD_TEXTS, documents, prose
from test_prefix_counts import LIBRARY, PATH, mixed

from authlytics.llm import bpe
from authlytics.llm.byte_pairs import read_vocabulary
from authlytics.llm.common import Work


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(PATH)


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_packed_numbers(n):
    values = np.random.default_rng(n).integers(0, 1 << 28, n) >> np.arange(n) % 28
    assert (bpe.unpack(bpe.pack(values)) == values).all()


@pytest.mark.parametrize("segment_words", [6_000_000, 200])
def test_round_trip(spark, vocabulary, monkeypatch, segment_words):
    monkeypatch.setattr(bpe, "SEGMENT_WORDS", segment_words)
    rows = ODD_TEXTS + [(100 + i, mixed(i, 200)) for i in range(200)] + [(400, prose(1, 20_000))]
    rows += [(500 + i, "hot " * 300) for i in range(40)]
    rows += [(600, "<|endoftext|>"), (601, "a<|endoftext|><|endoftext|> b<|endoftext"), (602, "a" * 9000)]
    docs = documents(spark, rows, 5)
    found = bpe.decode(bpe.encode(docs, vocabulary, Work(spark)), vocabulary).collect()
    result = sorted(
        ((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in found), key=repr
    )
    expected = []
    for doc_id, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, ids, LIBRARY.decode(ids, skip_special_tokens=False)))
    assert result == sorted(expected, key=repr)
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in found)


def test_decoding_any_ids(spark, vocabulary):
    codes = [[0, 50256, 5], [], None, [10**6, 64], [220, 188]]
    rows = [(i, None if c is None else np.array(c, "<u4").tobytes()) for i, c in enumerate(codes)]
    encoded = spark.createDataFrame(rows, "decoded long, ids binary")
    found = {r["decoded"]: r["text"] for r in bpe.decode(encoded, vocabulary, "text").collect()}
    assert found[0] == LIBRARY.decode([0, 50256, 5], skip_special_tokens=False)
    assert found[1] == "" and found[2] is None
    assert found[3] == LIBRARY.decode([64], skip_special_tokens=False)
    assert found[4] == LIBRARY.decode([220, 188], skip_special_tokens=False)


def test_each_distinct_word_is_encoded_once(vocabulary):
    import pyarrow as pa

    calls = []
    pairs = bpe._loaded(vocabulary)
    encode = type(pairs).encode

    class Sent:
        value = vocabulary

    words = [b" the", b" cat"]
    sizes = bpe.pack(np.array([len(w) for w in words]))
    batch = pa.table(
        {
            "segment": [1, 2, 3],
            "owned": pa.array([bpe.pack(np.array([0, 1]))] * 3, pa.binary()),
            "lengths": pa.array([sizes] * 3, pa.binary()),
            "words": pa.array([b"".join(words)] * 3, pa.binary()),
        }
    )
    try:
        type(pairs).encode = lambda self, word: calls.append(word) or encode(self, word)
        answers = bpe._encode_distinct(Sent)(batch)
    finally:
        type(pairs).encode = encode
    assert calls == words
    assert bpe.unpack(answers.column("ids")[2].as_py()).tolist() == [
        i for w in words for i in pairs.encode(w)
    ]


def test_empty_table(spark, vocabulary):
    docs = documents(spark, ODD_TEXTS).limit(0)
    assert bpe.decode(bpe.encode(docs, vocabulary, Work(spark)), vocabulary).count() == 0


def test_path_of_the_vocabulary_is_a_parameter(tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json")) as source:
        (tmp_path / "copy.json").write_text(source.read())
    assert read_vocabulary(str(tmp_path / "copy.json")) == read_vocabulary(PATH)
