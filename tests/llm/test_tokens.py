from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stocktake.llm import token_store as T
from stocktake.llm.tokens import UnitEncoder, encoder

from .cases import documents, texts

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
CHARS = st.sampled_from(list("ab'sT.,| \n\t\x0b\x0c\r\x00 \u0085　\x1cé") + ["  ", "\n\n", " don't", " I'LL", "<|endoftext|>", "é", "İ", "ß", "\U0001f600", "12"] + [a + m for a in "TJHWaÉ" for m in "\u0301\u0308\u030a\u030c\u0331"])


@pytest.mark.parametrize("name", FILES)
def test_units_give_the_ids_of_whole_texts(name):
    path = public_tokenizers.path(name)
    plain, known = Tokenizer.from_file(path), UnitEncoder(path)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(CHARS, max_size=12).map("".join), max_size=5))
    def check(rows):
        ids, offsets = known.encode(pa.array(rows, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in rows]

    check()


@pytest.mark.parametrize("name", FILES)
def test_hard_cases_and_a_small_kept_table(name, monkeypatch):
    from stocktake.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_UNITS", 3)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    rows = [t for _, t, _ in texts()]
    for _ in range(2):
        ids, offsets = encoder(public_tokenizers.path(name)).encode(pa.array(rows))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [plain.encode(t or "", add_special_tokens=False).ids for t in rows]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.just(2**60), st.just(2**60 - 1)), max_size=40), st.integers(0, 60))
def test_simple8b_round_trip(values, times):
    values = np.array(values * times, np.uint64)
    words, first, exceptions = T.encode(values)
    assert T.decode(words, first, exceptions, len(values)).tolist() == values.tolist()
    assert len(exceptions) == int((values >= 2**60).sum())


def test_small_ids_take_little_room():
    assert len(T.encode(np.zeros(1024, np.uint64))[0]) == 9
    assert len(T.encode(np.full(1020, 2**15 - 1, np.uint64))[0]) == 255


def test_round_trip_of_hard_cases(spark, monkeypatch):
    from stocktake.llm import blocks

    rows = texts()
    plain = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    found = T.token_round_trip(documents(spark, rows), public_tokenizers.path(FILES[0])).collect()
    ids = {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, T.END_ID], "<u4") for i, t, _ in rows}
    order = sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i))
    at, want = 0, []
    for i in order:
        want.append((i, at, len(ids[i]), crc32(ids[i].tobytes())))
        at += len(ids[i])
    assert sorted((tuple(r) for r in found), key=lambda r: r[1]) == want
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 4)
    assert T.token_round_trip(documents(spark, []), public_tokenizers.path(FILES[0])).count() == 0


def test_many_blocks(spark):
    from stocktake.llm.blocks import ordered_blocks
    from stocktake.llm.text import text_rows

    rows = [(k * 7 % 101, f"text {k}", "en") for k in range(101)]
    blocks = {r.doc_id: r.block for r in ordered_blocks(text_rows(documents(spark, rows)), block_rows=10).collect()}
    assert len(set(blocks.values())) > 5 and [blocks[k] for k in range(101)] == sorted(blocks.values())


def test_a_broken_file_is_refused(tmp_path):
    path = tmp_path / "x"
    path.write_bytes(b"nonsense" * 20)
    with path.open("rb") as file, pytest.raises(ValueError):
        next(T.segments(file))


@pytest.mark.parametrize("file", FILES)
def test_a_word_before_a_stop_is_encoded_once(file, monkeypatch):
    from stocktake.llm.tokens import UnitEncoder

    encoder, asked = UnitEncoder(public_tokenizers.path(file)), []
    plain = encoder._letters
    monkeypatch.setattr(encoder, "_letters", lambda unit: asked.append(unit) or plain(unit))
    text = "the Water over water the. Water, over, water."
    ids, _ = encoder.encode(pa.array([text]))
    assert ids.tolist() == Tokenizer.from_file(public_tokenizers.path(file)).encode(text, add_special_tokens=False).ids
    assert len(asked) <= 5 and not {".", ","} & set(asked)


def test_widths_of_large_values():
    for top in (1 << 51, 1 << 53, (1 << 59) + 1, (1 << 64) - 1):
        values = np.array([0, 1, 2, 3, top - 1, top, 7], np.uint64)
        assert np.array_equal(T.decode(*T.encode(values), len(values)), values)


@pytest.mark.parametrize("file", FILES)
def test_punctuation_after_a_word_goes_to_the_library_once(file, monkeypatch):
    plain, known, asked = Tokenizer.from_file(public_tokenizers.path(file)), UnitEncoder(public_tokenizers.path(file)), []
    whole = known._whole
    monkeypatch.setattr(known, "_whole", lambda unit: asked.append(unit) or whole(unit))
    text = "the water### and Water$$$ over### Été$$$ over!' _a_ x;` o; é### 12###"
    ids, _ = known.encode(pa.array([text]))
    assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert asked.count("###") == asked.count("$$$") == 1 and not any("water" in u.lower() for u in asked)


def test_kept_units_stay_within_their_bound(monkeypatch):
    from stocktake.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_UNITS", 8)
    known = UnitEncoder(public_tokenizers.path(FILES[0]))
    known.encode(pa.array([" ".join(f"w{k}" for k in range(100))]))
    assert len(known.kept) + len(known.older) <= 8
