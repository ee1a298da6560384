import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabml.llm import encoding, packing, queries, tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = ["a", "B", "é", "Σ", "İ", "'s", ",", ".", "!?", " ", "  ", "\n", "\t", "\x1c", " ", "́", "7", "語", "<|endoftext|>", "word", "²", "😀"]


def library(path, texts):
    tok = Tokenizer.from_file(path)
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path,drops", [(BYTE, False), (WORD, True)])
def test_encoder_equals_the_library(path, drops):
    enc = encoding.Encoder(path, drops)
    tok = Tokenizer.from_file(path)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from(ALPHABET), max_size=12).map("".join))
    def check(text):
        ids = np.frombuffer(enc.encode(text), "<u4").tolist()
        assert ids == tok.encode(text, add_special_tokens=False).ids

    check()


def test_encoder_cache_turns_over(monkeypatch):
    monkeypatch.setattr(encoding, "CACHE", 5)
    enc, texts = encoding.Encoder(BYTE), ["some words come back", "other words", "x" * 100 + " tail", "some words again and again"] * 3
    assert [len(enc.encode(t)) // 4 for t in texts] == [len(i) for i in library(BYTE, texts)]


def test_piece_models_are_counted_too():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for text in ("two  words", "", "ÀÉ\n x"):
        assert encoding.Encoder(path).count(text) == len(model.encode(text))


def test_counts_and_cache(spark, odd, none, tmp_path):
    cache = str(tmp_path / "cache")
    rows = odd.collect()
    expected = Counter((r["doc_id"], len((r["text"] or "").encode()), len(ids)) for r, ids in zip(rows, library(BYTE, [r["text"] for r in rows])))
    first = tokens.token_counts(odd, BYTE, cache).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in first) == expected
    assert not any(r["cached"] for r in first)
    distinct = len({r["text"] or "" for r in rows})
    assert spark.read.parquet(cache).count() == distinct  # each content once
    again = tokens.token_counts(odd, BYTE, cache).collect()
    assert all(r["cached"] for r in again) and spark.read.parquet(cache).count() == distinct
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in again) == expected
    # Another tokenizer version misses; a new text is the only miss of the old one.
    tokens.token_counts(odd, WORD, cache).collect()
    assert spark.read.parquet(cache).count() == 2 * distinct
    more = odd.unionByName(odd.limit(1).selectExpr(*["'brand new'" + f" as {c}" if c == "text" else c for c in odd.columns]))
    assert sum(not r["cached"] for r in tokens.token_counts(more, BYTE, cache).collect()) == 1
    assert tokens.token_counts(none, BYTE, cache).collect() == []


def check_packing(texts, rows, length):
    """Every id in one piece, no gap in a text or sequence; returns the ids of padding."""
    ids = {k: np.array(i + [2], "<u4") for k, i in zip(texts, library(WORD, texts.values()))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts, size in [*((v, len(ids[k])) for k, v in by_doc.items()), *((v, None) for v in by_sequence.values())]:
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == size if size else at <= length
    assert set(by_doc) == set(texts)
    return sum(length - sum(n for _, n in v) for v in by_sequence.values()), len(by_sequence)


def test_packing_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    padding, sequences = check_packing(texts, queries.op6_online_packing(spark, sf).collect(), 4096)
    assert padding < 0.02 * sequences * 4096 + 4096


def test_leftovers_merge_over_levels(spark, sf, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(11, "doc_id")
    pieces = packing.packed(docs, WORD, 2, length=256, open_windows=4, least_cut=8, drops_space=True)
    rows = pieces.selectExpr("*", "crc32(ids) as ids_crc32").collect()
    padding, sequences = check_packing({r["doc_id"]: r["text"] for r in docs.collect()}, rows, 256)
    assert padding < 8 * sequences + 256


def test_packing_odd_input(odd, none):
    rows = packing.packed(odd, WORD, 2, length=64, open_windows=3, drops_space=True).collect()
    expected = [len(i) + 1 for i in library(WORD, [r["text"] for r in odd.collect()])]
    assert sum(r["length"] for r in rows) == sum(expected)
    assert sum(r["start"] == 0 for r in rows) == len(expected)
    assert packing.packed(none, WORD, 2).collect() == []


def test_open_windows_are_bounded():
    rng, packer, full = np.random.default_rng(2), packing.Packer(100, 5, 10), []
    sizes = rng.integers(1, 260, 500)
    for k, n in enumerate(sizes):
        full += packer.add((k, 0, bytes(4 * int(n)), int(n)))
        assert len(packer.open) <= 5 and sum(w.size for _, _, w in packer.open) < 500
    more, last = packer.close()
    assert sum(w.size for w in [*full, *more, last]) == sizes.sum()
    assert all(90 < w.size <= 100 for w in full) and all(w.size == 100 for w in more)


def test_stops_stay_with_their_word():
    """A word with a comma or full stop is one chunk, with the library's ids."""
    from tabml.llm.encoding import Encoder

    enc = Encoder(public_tokenizers.path("word_bpe_49k.json"), drops_space=True)
    text = "Some words, and more. Numbers 1, 2. End."
    assert enc.encode(text) == enc._encoded([text])[0]
    assert "words," in enc.rest.young


def test_blocks_of_texts_equal_the_library():
    enc = encoding.Encoder(WORD, drops_space=True)
    more = [*ALPHABET, "$$$", "_", "'", "'ll", "J", "̌", "ª", "µ", "À", "×", "<|", "|", "&&&", "<|ENDOFTEXT|>", "\xa0", "\x0b", "\x85"]

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(more), max_size=10).map("".join), max_size=6))
    def check(texts):
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode_all(texts)] == library(WORD, texts)

    check()


def test_a_block_looks_up_each_chunk_once(monkeypatch):
    """Twenty texts of 4,000 words with five distinct chunks: five are looked up, and none needs the whole library."""
    enc, seen, whole = encoding.Encoder(WORD, drops_space=True), [], []
    fill = enc._fill
    monkeypatch.setattr(enc, "_fill", lambda words, *rest: seen.append(len(words)) or fill(words, *rest))
    texts = ["Some words, zzqxj&&& | über. " * 800 + str(i) for i in range(20)]
    expected = library(WORD, texts)
    encoded = enc._encoded
    monkeypatch.setattr(enc, "_encoded", lambda words: whole.extend(words) or encoded(words))
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode_all(texts)] == expected
    assert seen == [25] and sorted(whole) == sorted(str(i) for i in range(20))
