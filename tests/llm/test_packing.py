import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tabledger.llm import packing

from .helpers import ODD, prose, table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_both_engines_give_the_same_ids():
    slow = Tokenizer.from_file(PATH)
    fast = packing.Encoder(PATH)
    assert fast.fast is not None
    for t in ["<|endoftext|>", "see <|endoftext|> here", "a<|endoftext|><|endoftext|>\n b", "<|endoftext", "It's  a\n\n test\t ", "Ñandú 𝒳 ４５ ٣  x", "'ll'LL", "a" * 500, *[prose(i, 50) for i in range(20)], *[x for x in ODD if x and len(x) < 1000]]:
        assert fast(t) == slow.encode(t, add_special_tokens=False).ids


def test_other_files_run_on_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.Encoder(path).fast is None
    assert packing.Encoder(path)("hello world") == Tokenizer.from_file(path).encode("hello world", add_special_tokens=False).ids


def test_round_trip(spark):
    texts = [(i, prose(i, 10 + 7 * i)) for i in range(60)] + [(90, "see <|endoftext|> here")] + [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, prose(3, 31))]
    rows = packing.pack(table(spark, texts, 4), PATH, window=256).collect()
    encode = packing.Encoder(PATH)
    ids = {id(r): np.frombuffer(r.ids, "<u4") for r in rows}
    assert all(len(ids[id(r)]) == r.length > 0 for r in rows)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for s, pieces in by_sequence.items():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]]
        assert sum(r.length for r in pieces) == 256 or s == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    stream, documents = [], []
    for s in sorted(by_sequence):
        for r in by_sequence[s]:
            assert r.opens == (r.start == 0) and r.start == len(stream)
            stream += ids[id(r)].tolist()
            assert r.closes == (len(stream) == r.doc_tokens)
            if r.closes:
                documents.append((str(r.doc_id), stream))
                stream = []
    assert sorted(documents) == sorted((str(i), encode(t or "") + [1]) for i, t in texts)
    assert packing.pack(table(spark, ["a"]).limit(0), PATH).count() == 0
