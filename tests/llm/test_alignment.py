import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import alignment
from strata.llm.alignment import align, aligner, byte_of_letter
from strata.llm.queries import op13_tokenizer_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["▁block", "a▁b", " leading", "  two", "tab\tand\r\nline\n\n\n", "<|endoftext|> and <s> </s> <unk> <0x41>", "nul\x00byte",
       "é ñ ß 中文 テスト 😀👍🏽", "é combining ​   nbsp ﻿", "a", " ", "\n", "\x85 ", "don't we'll I'M", "12345 3.14 x²", "ﬁ ligature Ⅷ"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(ids, entry):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(entry(i))))
        at = out[-1][2]
    return out


def expected(rows, plain):
    tokenizer, pieces = plain
    own = byte_of_letter()
    entry_a = lambda i: bytes(own[c] for c in tokenizer.id_to_token(i))
    entry_b = lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    docs, counts = {}, Counter()
    for key, text in rows:
        ids_a, ids_b = (tokenizer.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)) if text else ([], [])
        if not text or any(b"".join(map(e, ids)) != (" " + text).encode() for e, ids in ((entry_a, ids_a), (entry_b, ids_b))):
            docs[key] = None
            continue
        sa, sb = spans(ids_a, entry_a), spans(ids_b, entry_b)
        links, j = [], 0
        for a, s, e in sa:
            while sb[j][2] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][1] < e:
                links.append((a, sb[k][0]))
                k += 1
        cuts = sorted({e for *_, e in sa} & {e for *_, e in sb})
        parts = {c: ([], []) for c in cuts}
        for side, tokens in enumerate((sa, sb)):
            at = 0
            for i, _, e in tokens:
                while cuts[at] < e:
                    at += 1
                parts[cuts[at]][side].append(str(i))
        digest = ";".join(",".join(x) + "|" + ",".join(y) for x, y in parts.values())
        counts.update(links)
        docs[key] = (len(sa), len(sb), len(cuts), links, hashlib.sha256(digest.encode()).hexdigest())
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = {k: (0, 0, 0, 0, 0, 0, "") if d is None else
           (*d[:3], len(d[3]), sum(counts[x] == most[x[1]] for x in d[3]), sum(counts[x] for x in d[3]), d[4]) for k, d in docs.items()}
    return out, counts


def got(df):
    return {r.doc_id: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()}


def test_query_against_brute_force(spark, prose, plain, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 5000)
    rows = list(enumerate([t for _, t in prose[0]] + ODD + ["the same text"] * 50))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want, counts = expected(rows, plain)
    assert got(op13_tokenizer_alignment(spark, str(tmp_path))) == want
    assert any(d[0] == 0 for k, d in want.items() if rows[k][1]) and sum(d[0] > 0 for d in want.values()) > 60
    pairs = align(spark.createDataFrame(rows, "doc_id long, text string"), A, B, keep=["doc_id"])[1]
    assert {(r.a, r.b): r.n for r in pairs.collect()} == counts


def test_given_table(spark, plain):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op13_tokenizer_alignment(spark, d)) == expected(rows, plain)[0]


def test_ids_are_those_of_the_file(plain):
    """The quick encoder gives the ids of the tokenizer that reads the file, for characters of every kind."""
    worker = aligner(A, B)
    texts = ["".join(f"a{chr(c)}{chr(c)} 1{chr(c)}" for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000) for lo in (*range(0, 0x3100, 256), 0xD700, 0xE000, 0xFE00, 0xFF00, 0x1F300, 0x1F600)]
    texts = [t for t in [*texts, *ODD, "x" * 5000, " " * 5000 + "x", "\n" * 3000] if t]
    mine, _ = worker.encoded(texts)
    assert [x.tolist() for x in mine] == [e.ids for e in plain[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_clashes_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "word", 5), (None, "word", 6), (3, None, 7)], "doc_id long, text string, n_a int").withColumn("own", F.lit("x"))
    rows = align(df, A, B)[0].collect()
    assert sorted((str(r.doc_id), r.own, r.n_a, r.count_sum) for r in rows) == [("3", "x", 0, 0), ("None", "x", 1, 2), ("None", "x", 1, 2)]
    empty, pairs = align(spark.createDataFrame([], "doc_id long, text string"), A, B, keep=["doc_id"])
    assert empty.collect() == [] and pairs.collect() == []
