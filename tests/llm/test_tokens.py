"""Token records and packing against plain encoding of each text."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from evenkeel.llm import packing, records
from evenkeel.llm.q_packing import op8_packing
from evenkeel.llm.q_records import op3_token_records
from evenkeel.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, start string, ids long"
TEXTS = [
    None,
    "",
    " ",
    "\n\n \t x",
    "One. Two!\nThree? Four",
    "a  b   c d  e\x85f\x1cg",
    "end <|endoftext|> of it<|endoftext|>",
    "ümlaut ñ 漢字 🙂 don't we'll",
    "no stop here " * 900,
    "Short. " * 3000,
    "x" * 30_000,
]
ROWS = [(i * 7 % 11, text, "clash", i) for i, text in enumerate(TEXTS)]
ROWS += [(50, "Twice. The same.", None, None)] * 2 + [(None, "no id", "a", 1)]
ROWS += [(100 + i, f"Sentence {i}. Another one follows it, {i * i}.\n" * (i % 9), "b", 2) for i in range(300)]


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def by_order(rows):
    return sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))


def test_store_of_words_changes_nothing():
    small = Encoder(PATH, most_bytes=1000)
    for _ in range(2):
        for text in TEXTS:
            assert small.ids(text or "").tolist() == plain(text)


def test_signs_at_the_borders_of_pieces():
    rng = random.Random(3)
    signs = ["a", "B", "7", "the", "'s", "'", ".", ",)", "-", "_", " ", "  ", "\n", "\t", "\x1c", "\x85", "\0", "é", "²", "漢", "\u0301", "🙂"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(6000)]
    got = Encoder(PATH).batch(texts)
    assert all(ids.tolist() == plain(text) for text, ids in zip(texts, got, strict=True))


def test_signs_behind_letters_with_accents_are_pieces_of_their_own():
    encode = Encoder(PATH)
    texts = [" caffè", " caffè,", " caffè...", ' caffè")', " cafés cafés!"]
    assert [ids.tolist() for ids in encode.batch(texts)] == [plain(text) for text in texts]
    assert sum("caffè" in piece for piece in encode.known) == 1
    assert sum("cafés" in piece for piece in encode.known) == 1


def test_each_sign_of_the_letters_that_close_a_piece():
    signs = [chr(c) for c in range(0xA0, 0x300)]
    texts = [f"a{c}, {c}b {c}\n{c}! x{c}7{c}" for c in signs] + ["".join(signs), " ".join(signs)]
    got = Encoder(PATH).batch(texts)
    assert all(ids.tolist() == plain(text) for text, ids in zip(texts, got, strict=True))


def test_pieces_of_a_failed_call_are_not_kept(monkeypatch):
    encode = Encoder(PATH)
    encode.ids("one two")
    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(encode, "_joined", lambda pieces: (_ for _ in ()).throw(OSError()))
        encode.ids("two three four")
    assert encode.ids("two three four").tolist() == plain("two three four")


def rows_of(sf):
    table = pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["doc_id", "text"])
    return sorted(zip(*(table[c].to_pylist() for c in table.column_names), strict=True))


def test_query_of_records(spark):
    expected, start = [], 0
    for doc_id, text in rows_of("sf0.001"):
        ids = plain(text)
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = op3_token_records(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected


def test_query_of_packing(spark):
    pieces = op8_packing(spark, "/root/testdata/sf0.001").collect()
    parts, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        parts[p.doc_id].append(p)
        windows[p.sequence_id].append((p.offset, p.length))
    docs = rows_of("sf0.001")
    assert set(parts) == {doc_id for doc_id, _ in docs}
    for doc_id, text in docs:
        ids, at = plain(text), 0
        for p in sorted(parts[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == crc(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)
    for window in windows.values():
        at = 0
        for offset, length in sorted(window):
            assert offset == at
            at += length
        assert at <= packing.WINDOW


@pytest.mark.parametrize("shards", [1, 5, None])
def test_records_round_trip(spark, tmp_path, shards):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    folder = f"file://{tmp_path}/records"
    records.write_records(docs, folder, PATH, shards=shards)
    expected, start = [], 0
    for doc_id, text, *_ in by_order(ROWS):
        ids = plain(text)
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    key = lambda r: r[1]
    for seed in (None, 7):
        got = [tuple(r) for r in records.digests(records.read_records(spark, folder, seed)).collect()]
        assert sorted(got, key=key) == expected
    only = records.digests(records.read_records(spark, folder, only=[50, 103])).collect()
    assert sorted(r.doc_id for r in only) == [50, 50, 103]


def test_a_wrong_byte_is_told(spark, tmp_path):
    folder = f"file://{tmp_path}/records"
    records.write_records(spark.createDataFrame([(1, "some words here", "", 1)], SCHEMA), folder, PATH, shards=1)
    path = tmp_path / "records" / "part-00000.rec"
    data = bytearray(path.read_bytes())
    data[25] ^= 1
    path.write_bytes(data)
    with pytest.raises(Exception, match="wrong checksum of a record"):
        records.read_records(spark, folder).collect()


def test_empty_tables(spark, tmp_path):
    nothing = spark.createDataFrame([], SCHEMA)
    records.write_records(nothing, f"{tmp_path}/records", PATH)
    assert records.read_records(spark, f"{tmp_path}/records").count() == 0
    assert packing.pack(nothing, PATH).count() == 0


def padding(length):
    return 0 if length & (length - 1) == 0 else packing.WINDOW - length


@pytest.mark.parametrize("block", [2000, packing.BLOCK])
def test_every_id_is_packed_once_in_order(spark, block):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    pieces = packing.digested(packing.pack(docs, PATH, block=block)).collect()
    windows, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
        parts[p.doc_id].append(p)
    total = pad = 0
    for window in windows.values():
        window.sort(key=lambda p: p.offset)
        assert [p.offset for p in window] == np.cumsum([0] + [p.length for p in window])[:-1].tolist()
        length = sum(p.length for p in window)
        assert length <= packing.WINDOW
        total, pad = total + length, pad + padding(length)
    assert total == sum(len(plain(text)) for _, text, *_ in ROWS)
    assert pad < 0.06 * total
    for doc_id, text, *_ in ROWS:
        if doc_id == 50:
            assert sorted(p.start for p in parts[50]) == [0, 0]
            continue
        ids, own = plain(text), sorted(parts[doc_id], key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert all(p.doc_tokens == len(ids) for p in own)
        assert all(crc(ids[p.start : p.start + p.length]) == p.ids_crc32 for p in own)
    order = [p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.doc_id is not None]
    assert order == sorted(order)


def test_cuts_cost_no_more_than_any_others():
    rng = np.random.default_rng(5)
    for _ in range(40):
        gaps = rng.integers(1, 9, 14)
        positions = np.concatenate([[0], np.cumsum(gaps)]).tolist()
        costs = [0] + rng.integers(0, 5, 14).tolist()
        window = 16
        best = [0] + [10**9] * 14
        for j in range(1, 15):
            for i in range(j):
                n = positions[j] - positions[i]
                if n <= window:
                    pad = 0 if n & (n - 1) == 0 else window - n
                    best[j] = min(best[j], best[i] + pad + costs[j] + 3)
        cuts = packing.best_cuts(positions, costs, window, 3)
        spent = 0
        for i, j in zip(cuts, cuts[1:], strict=False):
            n = positions[j] - positions[i]
            assert n <= window
            spent += (0 if n & (n - 1) == 0 else window - n) + costs[j] + 3
        assert spent == best[-1]
