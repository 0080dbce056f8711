from collections import defaultdict

import pytest

from tabledger.llm import sharding

from .helpers import ODD, prose, table


@pytest.mark.parametrize("limit", [300, 5_000, 1 << 30])
def test_only_oversized_buckets_split(spark, limit):
    texts = [(i, prose(i, 5 + i % 40)) for i in range(200)] + [(900, "same row")] * 120 + [(500 + i, t) for i, t in enumerate(ODD)] + [(None, "x")]
    out = sharding.directory(table(spark, texts), limit).collect()
    assert sorted((str(r.doc_id), r.n_bytes) for r in out) == sorted((str(i), len((t or "").encode())) for i, t in texts)
    size, count = defaultdict(int), defaultdict(int)
    for r in out:
        size[r.shard] += r.n_bytes
        count[r.shard] += 1
        assert len(r.shard) == r.depth
    assert all(size[s] <= limit or count[s] == 1 for s in size)
    assert all((r.shard_bytes, r.shard_docs) == (size[r.shard], count[r.shard]) for r in out)
    names = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    start = min(map(len, names))
    for name in names:  # a bucket was split only because its parent held too much
        if len(name) > start:
            inside = [r for r in out if r.shard.startswith(name[:-1])]
            assert sum(r.n_bytes for r in inside) > limit and len(inside) > 1


def test_written_shards(spark, tmp_path):
    docs = table(spark, [(i % 3, "same") for i in range(60)] + [(None, None)])
    sharding.write_shards(docs, 40, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 61
    assert all(r.b <= 40 for r in back.groupBy("shard").agg({"n_chars": "sum"}).toDF("s", "b").collect())
    assert sharding.directory(docs.limit(0), 40).count() == 0
