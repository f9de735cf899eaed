import json
from zlib import crc32

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from corpusloom.llm import packing
from corpusloom.llm.queries import TOKENIZER, llm_queries
from corpusloom.llm.shared import table


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def check(rows, texts, tokenizer):
    """Pieces tile every document; ids are the library's; sequences are gapless and equal buckets."""
    documents = {}
    for r in rows:
        documents.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        pieces = sorted(documents[doc_id, len(ids)], key=lambda r: r["start"])
        places = sorted({(p["start"], p["length"], p["ids_crc32"]) for p in pieces})
        at = 0
        for start, length, digest in places:
            assert start == at and length & (length - 1) == 0 and length <= 2048
            assert digest == crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    numbers = sorted(rows, key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in numbers] == list(range(len(numbers)))
    lengths = [r["length"] for r in numbers]
    assert lengths == sorted(lengths, reverse=True)
    assert all(r["offset"] == 0 for r in rows)


def test_edges(edge_docs, edge_texts):
    rows = packing.pack_documents(edge_docs, TOKENIZER).collect()
    check(rows, edge_texts, library())
    assert sum(r["doc_id"] == 7 and r["start"] == 0 for r in rows) == 2
    (null,) = [r for r in rows if r["doc_id"] == 1]
    assert (null["length"], null["doc_tokens"]) == (1, 1)


def test_whole_table(spark, small):
    texts = [(r[0], r[1]) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    check(llm_queries()["op3_packing"](spark, small).collect(), texts, library())


def test_ids_and_empty(edge_docs, no_docs):
    row = packing.pack_documents(edge_docs, TOKENIZER, with_ids=True).filter("length > 4").first()
    assert crc32(np.array(row["ids"], dtype="<u4").tobytes()) == row["ids_crc32"]
    assert packing.pack_documents(no_docs, TOKENIZER).count() == 0


def test_lengths():
    assert list(packing.piece_lengths(4096 + 7, 2048)) == [2048, 2048, 4, 2, 1]
    assert list(packing.piece_lengths(0)) == []
    assert json.loads(open(TOKENIZER).read())["model"]["type"] == "BPE"
