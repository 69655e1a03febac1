import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from strata.llm.common import text_buffer
from strata.llm.hilbert import hilbert_keys
from strata.llm.packing import WordTokens, pack
from strata.llm.queries import op2_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(rows, pieces, sequence=4096):
    """An exact round trip: all ids once, sequences gapless, full or a power of two."""
    tokenizer = Tokenizer.from_file(PATH)
    own, by_sequence = {}, {}
    for p in pieces:
        own.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert len(own) == len(rows)
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(own[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == sequence or at & (at - 1) == 0 and at < sequence


def test_round_trip(spark, tmp_path, prose):
    spark.createDataFrame(prose[0], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    check_pieces(prose[0], [r.asDict() for r in op2_packing(spark, str(tmp_path)).collect()])


def test_round_trip_of_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(rows, [r.asDict() for r in op2_packing(spark, d).collect()])


def test_words_give_the_tokenizers_ids():
    texts = ["I've DON'T we'll 'tis 's.'s can't, it's: they'RE!!", "a.b,c;d:e!f?g..h", "<|endoftext|> x<|ENDOFTEXT|>y <|startoftext|>.",
             "Élan vital.À é, ß; İstanbul.İ KK ẞ", "12.5 3,000 ½ ² x²y", "日本語。テキスト, ok.", "é́.é a̸.̸",
             "tab\tnew\nline\x0b\x0c\r\x1c\x85 \xa0nbsp wide", "emoji 🎉🎉. 👩‍🚀!", "", " ", ".", "\x00 \x01a.", "Σίσυφος ΣΑΣ.", "a-b_c/d\\e (f) [g] \"h\""]
    words = WordTokens(PATH)
    for group in [texts, *([t] for t in texts), [x.replace("<|", "< |") for x in texts]]:
        ids, counts = words.encode(*text_buffer(pa.array(group)))
        ends = np.cumsum(counts)
        for text, a, b in zip(group, ends - counts, ends):
            assert ids[a:b].tolist() == ids_of(text)[:-1], text


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        order = points[np.argsort(hilbert_keys(points, bits))]
        assert sorted(hilbert_keys(points, bits).tolist()) == list(range(len(points)))
        assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_null_ids_repeated_rows_ties_and_empty_table(spark):
    rows = [(None, "same words"), (1, "same words"), (1, "same words"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = pack(df, PATH, sequence=4).collect()
    n = sum(len(ids_of(t)) for _, t in rows)
    assert sum(p.length for p in pieces) == n and all(len(p.ids) == 4 * p.length for p in pieces)
    assert pack(df.limit(0), PATH).collect() == []
