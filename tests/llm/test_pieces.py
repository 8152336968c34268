import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from grantlake.llm.pieces import SPACE, Pieces, decode, encode
from grantlake.llm.queries import op12_sentencepiece
from tests.llm.odd import documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    return Pieces(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_random_strings_of_pieces(own, library):
    rng = random.Random(1)
    letters = list("ab \n\tthe  ing▁—é日\U0001f600<>0x41#_- ")
    for _ in range(20000):
        text = "".join(rng.choice(letters) if rng.random() < 0.7 else own.pieces[rng.randrange(259, 32000)].replace(SPACE, " ") for _ in range(rng.randint(0, 30)))
        assert own.encode(text) == library.encode(text), text
        assert own.decode(own.encode(text)) == library.decode(library.encode(text)), text


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    pieces, library = _both()
    assert pieces.encode(text) == library.encode(text) and pieces.decode(pieces.encode(text)) == library.decode(library.encode(text))


def _both(kept=[]):  # noqa: B006
    if not kept:
        kept += [Pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)]
    return kept


def test_decode_of_any_ids(own, library):
    rng = random.Random(2)
    for _ in range(20000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(280) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_long_parts_runs_of_spaces_and_no_cuts(own, library):
    for n in (1, 2, 15, 16, 17, 18, 33, 100):
        for word in ("", "a", "日", "the", " x"):
            assert own.encode(" " * n + word) == library.encode(" " * n + word)
    for text in ("a" * 50000, "ab" * 30000, " " * 50000, "aAbB1-" * 20000, "日本" * 20000, "thering" * 9000, "".join(random.Random(7).choice("thernigao") for _ in range(40000))):
        assert own.encode(text) == library.encode(text)
        whole = [i for p in own.split(SPACE + text.replace(" ", SPACE)) for i in ([own.ids[p]] if p in own.ids else [own.bytes[b] for b in p.encode()])]
        assert whole == library.encode(text)


def test_every_neighbour_is_judged_as_the_merge_procedure_does(own):
    rng = random.Random(3)
    some = sorted(own.merges)
    for _ in range(5000):
        a, b = rng.choice(some), rng.choice(some)
        assert own.fits(a, b) == (own.merge(a + b)[0] == [a, b])


def test_failed_positions_are_taken_back(spark, tmp_path):
    """A vocabulary in which the longest match leads to a dead end again and again."""
    def field(n, kind, data):
        size = b"" if kind == 0 or kind == 5 else bytes([len(data)])
        return bytes([n << 3 | kind]) + size + data

    import struct

    names = ["a", "b", SPACE, "ab", "ba", "bab", "abab", "aab"]
    pieces = [("<unk>", 2, 0.0), *((f"<0x{i:02X}>", 6, 0.0) for i in range(256)), *((p, 1, -float(i)) for i, p in enumerate(names))]
    model = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, k, s in pieces)
    trainer = field(3, 0, b"\x02") + b"\x98\x02\x01"
    model += field(2, 2, trainer) + field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00"))
    path = str(tmp_path / "own.model")
    with open(path, "wb") as f:
        f.write(model)
    mine = Pieces(path)
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 60)))
        assert mine.split(text) == mine.merge(text)[0]


def test_query_on_the_tables(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = {}
    for r in docs.collect():
        ids = library.encode(r.text or "")
        expected[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert {r.doc_id: tuple(r)[1:] for r in op12_sentencepiece(spark, sf).collect()} == expected


def test_odd_rows(spark, library):
    docs = documents(spark).withColumnRenamed("class_id", "ids").withColumnRenamed("score", "decoded").withColumnRenamed("lang", "c0")
    out = decode(encode(docs))
    assert out.columns == [c for c in docs.columns if c not in ("ids", "decoded")] + ["ids", "decoded"]
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids) and r.c0 == "en" for r in rows)
    assert [(r.ids, r.decoded) for r in encode(docs, decoded="decoded").collect()] == [(r.ids, r.decoded) for r in rows]
    assert decode(encode(docs.limit(0))).count() == 0
    assert decode(spark.createDataFrame([(None,), ([None, 264],)], "ids array<int>")).collect()[1].decoded == "a"


def test_other_models_are_refused(tmp_path):
    (tmp_path / "m").write_bytes(b"")
    with pytest.raises(ValueError):
        Pieces(str(tmp_path / "m"))
