import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from usagelake.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("byte_bpe_50k.tiktoken"))


def check(rows, texts, tokenizer, length=1024):
    """Round trip: ids, cuts and places of every document, given as (doc_id, text) pairs."""
    want = []
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % length or length
        cuts = [0, *range(first, len(ids) + 1, length)]
        want += [(doc, n, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes()))
                 for n, (s, e) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda x: (x[0] is not None, x)
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        end = 0
        for offset, n in sorted(p):
            assert offset == end
            end += n
        assert end <= length
    return len(places), sum(w[3] for w in want)


def test_round_trip_and_few_sequences(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    used, tokens = check(packing.op8(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert used <= -(-tokens // 1024) + 3


def test_odd_rows(odd, empty, tokenizer):
    check(packing.op8(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()], tokenizer)
    assert packing.op8(empty).collect() == []


@pytest.mark.parametrize("text", ["<|endoftext|> a", "don't  stop \n\n now ", "x" * 5000, "日本語 текст  z", "a\tb\x1cc",
                                  "Ünïcödé straße — “q” …", " lead", "trail ", "1234 56.78 $%^&*", "é́ ​"])
def test_both_encoders_agree(text, tokenizer, encoder):
    raw = [t.encode() for t in ("", text, "lead  in", text + " " + text, "", text)]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    got = [i.tolist() for i in encoder.texts(np.frombuffer(b"".join(raw), np.uint8), off)]
    assert got == [tokenizer.encode(r.decode(), add_special_tokens=False).ids for r in raw]


@given(st.lists(st.lists(st.sampled_from([" ", "  ", "\n", "a", "B", "'s", "'", "12", ".", "é", "ß", "!?", "\t", "\xa0", "the", "-"]),
                max_size=25).map("".join), min_size=1, max_size=5))
@settings(max_examples=300, deadline=None)
def test_both_encoders_agree_on_any_mixture(tokenizer, encoder, texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    got = [i.tolist() for i in encoder.texts(np.frombuffer(b"".join(raw), np.uint8), off)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 700, 300).tolist()
    people = []
    for _ in range(2):
        bins, fill = [], []
        packing.best_fit(bins, fill, rng.permutation(300).tolist(), sizes, 1024)
        people.append((bins, fill))
    bins, fill = packing.crossover(*people, sizes, 1024, rng)
    assert sorted(i for b in bins for i in b) == list(range(300))
    assert fill == [sum(sizes[i] for i in b) for b in bins] and max(fill) <= 1024


def test_evolution_does_not_lose_the_elite():
    rng = np.random.default_rng(1)
    sizes = rng.integers(200, 500, 400).tolist()
    elite = packing.evolve(sizes, 1024, [], rng)
    again = packing.evolve(sizes, 1024, [elite], rng)
    assert again.max() <= elite.max()


def test_many_blocks(spark):
    rng = np.random.default_rng(2)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(rng.integers(1, 1024, 3000))], "row long, length long")
    out = packing.pack(items, 1024, block=500).toPandas()
    assert sorted(out["row"]) == list(range(3000))
    fill = out.groupby("sequence")["length"].sum()
    assert fill.max() <= 1024 and (out.groupby("sequence")["filled"].first() == fill).all()
    assert len(fill) <= 1.03 * out["length"].sum() / 1024 + 6
