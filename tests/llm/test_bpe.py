"""Encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import tempfile

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lexicon(vocabulary, words):
    with tempfile.NamedTemporaryFile(suffix=".bin") as f:
        f.write(bpe.compile_lexicon(vocabulary, words))
        f.flush()
        return bpe.Lexicon(f.name)


def odd_texts():
    rng = random.Random(3)
    alphabet = ["a", "s", "t", "re", "ll", "'", "'s", "'ve", "ve", "d", " ", "  ", "\n", "\t", "1", "23", "!", "?", "é", "ß", "中", "　", "\xa0", "🙂", "<|endoftext|>", "<|endof", "\0", "İ", "٣", "​", "The", " the"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    out += ["", " ", "\n\n", "<|endoftext|>", " <|endoftext|> ", "a  <|endoftext|>b", "'s", " 's", "it's 'sound ''s l'ls", "a" * 5000, "ab" * 3000, "\0zero\0" * 30]
    return out


def encoded(own, texts):
    data = [t.encode() for t in texts]
    ids, at = bpe.encode_slice(own, np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data], dtype=np.int64)))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]  # noqa: B905


@pytest.mark.parametrize("words", [[], [b"a", b" the", b"The", b"'s", b"ab" * 9, b"\xc3\xa9", b" ", b"aa", b"aaa"]])
def test_ids_of_odd_texts(vocabulary, library, words):
    """Apostrophes, white space, other scripts, added tokens, long pieces: the library's ids, whatever the lexicon holds."""
    texts = odd_texts()
    for some in (texts, *[[t] for t in texts[:200]]):
        assert encoded(lexicon(vocabulary, words), some) == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_classes_of_all_characters(vocabulary, library):
    cut = library.pre_tokenizer.pre_tokenize_str
    own = lexicon(vocabulary, [])
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(every), 50_000):
        text = "".join(f"a{c}1{c}!{c} {c}" for c in every[lo : lo + 50_000])
        data = text.encode()
        starts, bounds, *_ = bpe.pieces(own, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        got = [data[a:b].decode() for a, b in zip(bounds, bounds[1:])]  # noqa: B905
        assert got == [text[a:b] for _, (a, b) in cut(text)]


def test_automaton_is_minimal_and_numbers_its_words():
    rng = random.Random(1)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(300)} | {b"x" + s for s in (b"ing", b"ed")} | {b"y" + s for s in (b"ing", b"ed")})
    auto = bpe.minimal_automaton(words)
    suffixes = {b"": frozenset(words)}  # a state for each set of right contexts
    for w in words:
        for i in range(1, len(w) + 1):
            suffixes[w[:i]] = frozenset(x[i:] for x in words if x.startswith(w[:i]))
    assert len(auto["final"]) == len(set(suffixes.values()))
    probes = [*words, b"", b"abcabcabc", b"x", b"xin", b"zz"]
    data = np.frombuffer(b"".join(probes) + b"\0", np.uint8)
    lens = np.array([len(p) for p in probes])
    got = bpe.find_words(auto, data, np.cumsum(lens) - lens, lens)
    assert got.tolist() == [words.index(p) if p in words else -1 for p in probes]
    assert bpe.find_words(bpe.minimal_automaton([]), data, np.array([0]), np.array([3])).tolist() == [-1]


def test_both_merges_agree(vocabulary):
    rng, pairs = random.Random(2), bpe.pair_table(vocabulary.merges, vocabulary.size)
    for _ in range(300):
        w = bytes(rng.choice(b"aabtheing \xc3\xa9") for _ in range(rng.randint(1, 48)))
        assert bpe.merge(w, vocabulary.first, pairs, vocabulary.size) == bpe.merge_long([vocabulary.first[b] for b in w], pairs, vocabulary.size)


def test_equal_hashes_are_told_apart(monkeypatch):
    data = np.frombuffer(b"abcabdabcxyz" + b"long string of bytes" * 2, np.uint8)
    starts, lens = np.array([0, 3, 6, 9, 12, 32, 0]), np.array([3, 3, 3, 3, 20, 20, 2])
    for clash in (False, True):
        if clash:
            monkeypatch.setattr(bpe.T, "mix", lambda x: x * np.uint64(0))
        one, group = bpe.distinct(data, starts, lens)
        texts = [data[a : a + n].tobytes() for a, n in zip(starts, lens, strict=True)]
        assert [texts[one[g]] for g in group] == texts and len(one) == len(set(texts))


@pytest.mark.parametrize("words", [0, 50, 65_536])
def test_encode_and_decode(docs, pairs, library, words, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 40)
    out = bpe.decode(bpe.encode(docs, PATH, words=words), PATH, name="text")
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.text) for r in out.collect()), key=str)
    want = [(d, library.encode(t or "", add_special_tokens=False).ids, t or "") for d, t in pairs]
    assert got == sorted(((d, len(i), np.array(i, "<u4").tobytes(), t) for d, i, t in want), key=str)


def test_decoding_of_any_ids(spark, library):
    rng = random.Random(4)
    lists = [[rng.choice([rng.randrange(50257), rng.randrange(256), 50256, 60_000]) for _ in range(rng.randint(0, 12))] for _ in range(200)]
    rows = spark.createDataFrame([(i, bytearray(np.array(x, "<u4").tobytes()), "x") for i, x in enumerate(lists)] + [(-1, None, "x")], "i long, ids binary, decoded string")
    got = {r.i: r.decoded for r in bpe.decode(rows, PATH).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)} | {-1: ""}


def test_empty_table(empty):
    assert bpe.decode(bpe.encode(empty, PATH), PATH).collect() == []


def test_query(spark, library):
    from millrace.llm import queries

    sf = "/root/testdata/sf0.001"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    out = queries.queries()["op13_bpe"](spark, sf)
    assert {tuple(r) for r in out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="only byte-level"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_shared_file_is_read_back(spark, vocabulary):
    name = bpe.share_file(spark, bpe.compile_lexicon(vocabulary, [b"of"]))
    assert spark.range(3).select(F.col("id")).mapInArrow(lambda it: (b for b in it if bpe.Lexicon(bpe.SparkFiles.get(name)).size == 50257), "id long").count() == 3
