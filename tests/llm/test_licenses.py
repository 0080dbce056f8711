import pytest

from tabledger.llm import licenses
from tabledger.llm.license_texts import PHRASES, TEMPLATES

from .helpers import ODD, table, words


def by_id(out):
    return {r.doc_id: r for r in out.collect()}


def test_optional_and_replaceable_regions():
    a = licenses.compiled("<<optional>> one <<optional>> two <<end>> <<end>> three <<any:2>> four")
    read = lambda text: a.read([w.encode() for w in text.split()], 0)[0]
    assert read("three four") == 2 and read("one three four") == 3 and read("one two three x y four five") == 6
    assert read("two three four") == -1 and read("three x y z four") == -1 and read("three") == -1
    assert a.depth[a.last] == 2


def test_full_texts_and_near_misses(spark):
    mit = next(t for _, n, t in TEMPLATES if n == "mit-text")
    full = " ".join(w for w in mit.replace("<<any:25>>", "(c) 2024 The Authors").replace("<<any:8>>", "the authors").split() if not w.startswith("<<"))
    out = by_id(licenses.scan(table(spark, [full.title(), full.replace("sublicense", "sell"), "see " + full + " end"])))
    assert [[m.name for m in out[i].templates if m.name == "mit-text"] for i in range(3)] == [["mit-text"], [], ["mit-text"]]
    assert out[2].templates[0].start == 1 and out[2].templates[0].end == len(words(full)) + 1
    assert out[1].share > 0.3


def test_phrases_against_brute_force(spark):
    texts = ["Under the MIT License. under-the-mit-license", "CC BY-NC 4.0 cc by nc", "Licensed under the Apache License, Version 2.0.", "under the mitlicense", *ODD]
    out = by_id(licenses.scan(table(spark, texts)))
    for i, t in enumerate(texts):
        w = words(t)
        want = [(label, s) for p, label in PHRASES for s in range(len(w)) if w[s : s + len(p.split())] == p.split()]
        assert sorted((m.label, m.start) for m in out[i].phrases) == sorted(want)
        assert out[i].n_words == len(w)
    assert {m.label for m in out[2].templates} == {"apache-2"}
    assert licenses.scan(table(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("label, name, markup", TEMPLATES)
def test_every_template_reads_its_own_wording(label, name, markup):
    a = licenses.compiled(markup)
    plain = [w.encode() for w in markup.split() if not w.startswith("<<")]
    assert a.read(plain, 0)[0] == len(plain)
