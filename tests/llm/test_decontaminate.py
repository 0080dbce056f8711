from collections import Counter

from tabledger.llm import decontaminate

from .helpers import ODD, prose, table, words


def brute(texts, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s : s + min(10, len(w))]), set()).add(i)
    out = []
    for i, t in texts:
        w, hit, ids = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s : s + n]))
                if found:
                    hit |= set(range(s, s + n))
                    ids |= found
        out.append((i, len(w), len(hit), tuple(sorted(ids))))
    return Counter(out)


def got(docs, bench):
    found = decontaminate.overlaps(docs, bench)
    rows = found.select("doc_id", "n_words", decontaminate.n_hit(found.spans).alias("n"), "item_ids").collect()
    return Counter((r.doc_id, r.n_words, r.n, tuple(r.item_ids)) for r in rows)


def test_against_brute_force(spark):
    items = [(k, prose(1000 + k, n, 50)) for k, n in enumerate([3, 9, 10, 11, 25, 40, 1])] + [(20, "go go go go go go go go go go go"), (21, None), (22, "!!")]
    texts = [(i, prose(i, 80, 50)) for i in range(40)]
    texts += [(100 + k, prose(k, 20) + " " + t.upper() + " " + prose(k + 1, 20)) for k, t in items if t]
    texts += [(200, " ".join(items[4][1].split()[3:13])), (201, " ".join(items[4][1].split()[3:12])), (202, "go " * 500)]
    # texts of 30,000 equal words are left out: with items of fewer than ten words they exhaust memory (README, Open)
    texts += [(300 + i, t) for i, t in enumerate(ODD) if len(t or "") < 100_000] + [(None, items[5][1]), (100, texts[40][1]), (100, texts[40][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = table(spark, texts)
    assert got(docs, bench) == brute(texts, items)
    long_only = [x for x in items if len(words(x[1])) >= 10]
    assert got(docs, spark.createDataFrame(long_only, bench.schema)) == brute(texts, long_only)
    bad = {k[0] for k in brute(texts, items) if k[2]}
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in texts if i not in bad)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    docs = table(spark, [(1, "some words"), (2, None)])
    assert got(docs, bench) == Counter([(1, 2, 0, ()), (2, 0, 0, ())])
    assert got(docs.limit(0), spark.createDataFrame([(1, "a b")], bench.schema)) == Counter()


def test_long_texts_beside_short_items(spark):
    items = [(k, prose(1000 + k, n, 50)) for k, n in enumerate([3, 9, 10, 25, 1])] + [(20, "word go"), (21, "long " * 3_000), (22, "go word")]
    long = prose(7, 30_000, 50)
    texts = [(i, t) for i, t in enumerate(ODD)] + [(100, long), (101, "go " + ODD[6] + "go " + items[3][1]), (102, ODD[5] + " " + items[1][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert got(table(spark, texts), bench) == brute(texts, items)
    short_only = [x for x in items if len(words(x[1])) < 10]
    assert got(table(spark, texts), spark.createDataFrame(short_only, bench.schema)) == brute(texts, short_only)


def test_phrase_in_many_items(spark):
    phrase = "as in the case"
    items = [(i, f"{prose(i, 12, 10**6)} {phrase} {prose(10_000 + i, 12, 10**6)}") for i in range(300)]
    texts = [(i, f"{prose(20_000 + i, 8, 10**6)} {phrase} " * 20) for i in range(30)] + [(100 + i, f"{items[i][1]} {phrase} {items[i + 1][1]}") for i in range(5)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert got(table(spark, texts), bench) == brute(texts, items)
    worded = bench.select("item_id", decontaminate.words_of(bench.text).alias("words"))
    # What a document's row meets has one window a row, not all of a hash: those that share the phrase would be hundreds.
    windows = {tuple(words(t)[s : s + 10]) for _, t in items for s in range(len(words(t)) - 9)}
    rows = decontaminate._windows(worded, 10).collect()
    assert len(rows) == len(windows) and max(len(str(r.asDict())) for r in rows) < 500
