import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from grantlake.llm.packing import LENGTH, SEGMENTS, Packer, pack, pack_conversations
from tests.llm.odd import ODD, documents


def held(rows, texts):
    """Every token once, sequences gapless and within limits; returns the padded share."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for d, t in texts.items()}
    of_doc, of_sequence = {}, {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        of_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        of_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padded = total = 0
    for pieces in of_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= LENGTH and len(pieces) <= SEGMENTS
        total += at
        padded += 0 if at & (at - 1) == 0 else LENGTH - at
    return of_doc, ids, padded / total


def test_pieces_cover_every_document_with_little_padding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    of_doc, ids, padded = held(pack(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert set(of_doc) == set(ids)
    for d, pieces in of_doc.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == len(ids[d])
    assert padded < 0.01
    fitting = [d for d in ids if len(ids[d]) <= LENGTH]
    assert sum(len(of_doc[d]) > 1 for d in fitting) < 0.02 * len(fitting)  # only the last ones of a task


def test_odd_rows(spark):
    docs = documents(spark)
    rows = pack(docs).collect()
    of_doc, ids, _ = held(rows, {i: t for i, t in ODD})
    assert set(of_doc) == set(ids) and sum(n for _, n in of_doc[5]) == 2 * len(ids[5])
    assert {r.length for r in rows if r.doc_id in (1, 2, 11)} == {1}
    assert pack(docs.limit(0)).count() == 0


def test_limits_on_segments_and_loss_tokens_hold():
    rng = np.random.default_rng(3)
    for most in (260, 90):  # with and without examples beyond a sequence
        packer = Packer(100, 4, 60, 8, 0)
        total, ids = {}, {}
        for d in range(300):
            n = int(rng.integers(1, most))
            total[d], ids[d] = n, rng.integers(0, 9, n).astype("<u4")
            packer.add(d, ids[d], rng.random(n) < rng.random())
        packer.finish()
        by = {}
        for doc_id, start, n, crc, _, sequence, offset, loss in packer.taken():
            by.setdefault(sequence, []).append((offset, n, loss))
            total[doc_id] -= n
            assert zlib.crc32(ids[doc_id][start : start + n].tobytes()) == crc
        assert not any(total.values())
        for pieces in by.values():
            pieces.sort()
            assert len(pieces) <= 4 and sum(p[1] for p in pieces) <= 100 and sum(p[2] for p in pieces) <= 60
            assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:i]) for i in range(len(pieces))]


def test_conversations_bear_loss_by_role(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    turns = sorted({tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()})
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids, marks = {}, {}
    for conv, _, role, text in turns:
        new = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        ids.setdefault(conv, []).extend(new)
        marks.setdefault(conv, []).extend([role == "assistant"] * len(new))
    rows = pack_conversations(table).collect()
    of_sequence, covered = {}, {c: 0 for c in ids}
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and r.loss_tokens == sum(marks[r.doc_id][r.start : r.start + r.length]) and r.first_turn == 0
        covered[r.doc_id] += r.length
        of_sequence.setdefault(r.sequence_id, []).append(r)
    assert covered == {c: len(x) for c, x in ids.items()}
    assert all(sum(r.length for r in x) <= LENGTH and sum(r.loss_tokens for r in x) <= LENGTH * 3 // 4 and len(x) <= SEGMENTS for x in of_sequence.values())
    assert any(sum(r.loss_tokens for r in x) > LENGTH // 2 for x in of_sequence.values())


def test_odd_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None), (1, 200, "assistant", "far"), (None, None, None, None), (2, 1, "assistant", "b " * 3000), (2, 0, "user", "")]
    table = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, doc_id int")
    out = pack_conversations(table).collect()
    assert {(r.doc_id, r.first_turn) for r in out} == {(1, 0), (1, 192), (None, None), (2, 0)}
    assert sum(r.length for r in out if r.first_turn == 0 and r.doc_id == 1) == 3
    assert pack_conversations(table.limit(0)).count() == 0


def test_short_documents_leave_no_padding(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " word" * rng.randint(0, 7)) for i in range(5000)], "doc_id long, text string").coalesce(1)
    rows = pack(docs).collect()
    ends = {}
    for r in rows:
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
    tokens = sum(r.length for r in rows)
    padded = sum(n if n & (n - 1) == 0 else 1024 for n in ends.values())
    assert tokens == sum(ends.values()) and padded <= 1.01 * tokens
