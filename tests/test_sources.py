"""JSON arrays in ranges, and the keyed vector store under several writers."""

import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from rankloom.operators.common import materialise
from rankloom.operators.dense import encode_texts
from rankloom.sources import json_array, manifest, vector_store

NASTY = [
    "plain", 'quote " and \\ and \\" end', "]},{[", '\\\\"', "[[[", "é漢😀\n\t", "", "\\", '\\u005c\\u0022', ",", '"},{"id":"fake"', "}" * 50, "\\" * 33,
]


def records(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        out.append({"id": str(i), "text": rnd.choice(NASTY) * rnd.randint(0, 4), "tags": [rnd.choice(NASTY) for _ in range(rnd.randint(0, 3))], "more": {"a": [{"b": rnd.choice(NASTY)}]}})
    return out


@pytest.mark.parametrize("range_bytes", [1, 7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("indent, ascii_only", [(None, True), (2, False)])
def test_ranges_give_the_elements(spark, tmp_path, range_bytes, indent, ascii_only):
    rows = records(12 if range_bytes < 64 else 150)
    path = tmp_path / "a.json"
    path.write_text(" \n" + json.dumps(rows, indent=indent, ensure_ascii=ascii_only) + "\n")
    if range_bytes > 1 or indent is None:
        ranges = [(str(path), at, min(at + range_bytes, path.stat().st_size)) for at in range(0, path.stat().st_size, range_bytes)]
        got = local_elements(path, ranges)
        assert [json.loads(v) for _, v in got] == rows


def local_elements(path, ranges):
    """The two passes without Spark around them."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([f"file:{p}" for p, _, _ in ranges]), pa.array([s for _, s, _ in ranges]), pa.array([e for _, _, e in ranges])], ["path", "start", "end"])
    scans = [tuple(r.values()) for b in json_array._scan(iter([batch])) for r in b.to_pylist()]
    starts = json_array._starts([(p, s, e, *scan[2:]) for (p, s, e), scan in zip(ranges, scans)], {})
    out = []
    for _, start, end, inside, depth in starts:
        with open(path, "rb") as source:
            out += list(json_array._range_elements(source, start, end, inside, depth))
    return out


@pytest.mark.parametrize("piece", [1, 3, 50])
def test_small_pieces(tmp_path, monkeypatch, piece):
    monkeypatch.setattr(json_array, "PIECE", piece)
    rows = records(10)
    path = tmp_path / "a.json"
    path.write_text(json.dumps(rows))
    size = path.stat().st_size
    assert [json.loads(v) for _, v in local_elements(path, [(str(path), a, min(a + 100, size)) for a in range(0, size, 100)])] == rows


def test_spark_reads_what_the_whole_file_gives(spark, tmp_path):
    for name, n in (("a.json", 300), ("b.json", 0), ("c.json", 1)):
        (tmp_path / name).write_text(json.dumps(records(n, n), ensure_ascii=False))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))])
    want = spark.read.schema(schema).json(str(tmp_path), multiLine=True)
    got = json_array.read_json_array(spark, str(tmp_path), schema, 500)
    key = lambda df: sorted((r.id, r.text, tuple(r.tags)) for r in df.collect())
    assert key(got) == key(want) and len(key(got)) == 301
    assert json_array.array_elements(spark, str(tmp_path), 500).rdd.getNumPartitions() > 50


@pytest.mark.parametrize("text, says", [('{"a": 1}', "begin with an array"), ('[{"a": 1}', "ends inside a bracket"), ('[{"a": "x]', "ends inside a string"), ('[1,,2]', "element is missing"), ("[1,]", "element is missing")])
def test_what_is_no_array(spark, tmp_path, text, says):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match=says):
        json_array.array_elements(spark, str(tmp_path / "a.json"), 3).collect()


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, content string")


def test_store_encodes_misses_only(spark, tmp_path):
    path = str(tmp_path / "v")
    first = texts(spark, [(1, "a b"), (2, "a b"), (3, None), (4, "c")])
    one = {r.doc_id: r.embedding for r in vector_store.update_store(spark, first, path, dim=4).collect()}
    assert len(one) == 4 and one[1] == one[2] and vector_store.read_store(spark, path).count() == 3
    vector_store.update_store(spark, first, path, dim=4)
    assert manifest.versions(spark, path) == [0]
    two = {r.doc_id: r.embedding for r in vector_store.update_store(spark, texts(spark, [(7, "c"), (8, "new")]), path, dim=4).collect()}
    assert two[7] == one[4] and manifest.versions(spark, path) == [0, 1] and vector_store.read_store(spark, path).count() == 4
    vector_store.compact(spark, path)
    assert sorted(r.key for r in vector_store.read_store(spark, path).collect()) == sorted({r.key for r in vector_store.read_store(spark, path).collect()})


def test_two_writers_add_a_key_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "v")
    vector_store.update_store(spark, texts(spark, [(0, "base")]), path, dim=4)
    keyed = lambda words: materialise(encode_texts(vector_store.with_key(texts(spark, list(enumerate(words))), "t"), dim=4).select("key", "embedding"))
    commit, raced = manifest.commit, []

    def overtaken(spark_, path_, version, state):
        if not raced:  # another writer commits between this one's look and its commit
            raced.append(version)
            vector_store.add_vectors(spark, path, keyed(["b", "c"]))
        commit(spark_, path_, version, state)

    monkeypatch.setattr(manifest, "commit", overtaken)
    vector_store.add_vectors(spark, path, keyed(["a", "b"]))
    keys = [r.key for r in vector_store.read_store(spark, path).collect()]
    assert raced and len(keys) == len(set(keys)) == 4 and manifest.versions(spark, path) == [0, 1, 2]


def test_a_look_up_opens_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "v")
    vector_store.update_store(spark, texts(spark, [(i, f"text {i}") for i in range(200)]), path, dim=4)
    one = vector_store.with_key(texts(spark, [(3, "text 3")]), vector_store.encoder_tag(dim=4, model="built-in"))
    found = vector_store.read_store(spark, path, one)
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket#" in filters and " = " in filters
    assert found.join(one, "key").count() == 1


def test_a_range_reads_its_own_bytes(tmp_path):
    """Every range took a whole piece, sixteen times the file for ranges of a quarter of a megabyte."""
    import pyarrow as pa

    rows = [{"id": i, "text": "x" * 900} for i in range(3000)]
    path = tmp_path / "array.json"
    path.write_text(json.dumps(rows))
    size, read, found = path.stat().st_size, 0, 0

    class Counting:
        def __init__(self, file):
            self.file, self.seek = file, file.seek

        def read(self, n):
            nonlocal read
            raw = self.file.read(n)
            read += len(raw)
            return raw

    ranges = [(f"file:{path}", a, min(a + (1 << 18), size)) for a in range(0, size, 1 << 18)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("path", "start", "end"), r)) for r in ranges])
    scans = [tuple(r.values()) for b in json_array._scan(iter([batch])) for r in b.to_pylist()]
    with open(path, "rb") as file:
        for _, start, end, inside, depth in json_array._starts([(p, a, e, *s[2:]) for (p, a, e), s in zip(ranges, scans)], {}):
            found += sum(1 for _ in json_array._range_elements(Counting(file), start, end, inside, depth))
    assert found == 3000 and read < 1.3 * size
