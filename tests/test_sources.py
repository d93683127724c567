from __future__ import annotations

import json

from foliograph.operators import folds
from foliograph.sources import crawl, documents
from foliograph.sources.graph_store import GraphStore
from foliograph.streaming import upsert
from pyspark.sql import functions as F


def test_documents(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"manual": {"slug": "em"}, "sections": [{"section_id": "A", "text": "t"}, {"base_path": "/x", "error": "fetch_failed"}]}))
    (tmp_path / "p.json").write_text(json.dumps({"pages": [{"base_path": "/y"}]}))
    (tmp_path / "_index.json").write_text("{}")
    (tmp_path / "x.txt").write_text("{}")
    docs = documents.read_documents(spark, str(tmp_path))
    assert sorted(r.slug for r in docs.collect()) == ["em", "p"]
    rows = documents.document_sections(docs)
    assert sorted((r.slug, r.position, r.error) for r in rows.collect()) == [("em", 0, None), ("em", 1, "fetch_failed"), ("p", 0, None)]
    assert documents.read_documents(spark, str(tmp_path), ["M.json"]).count() == 1
    out = str(tmp_path / "out")
    assert documents.write_documents(rows, out) and not documents.write_documents(rows, out)
    assert spark.read.json(out).count() == 2


def test_cache(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"key":"a","result":"1"}\n{"key":"a","result":"2"}\n{"result":"3"}\n{"key":"b","resu')
    got = documents.latest(documents.read_cache(spark, str(tmp_path)))
    assert [tuple(r) for r in got.collect()] == [("a", "2")]


def test_salvage(spark):
    texts = ['{"a":1}', '<think>{"x":2}</think>```json\n{"a":1}\n```', 'Sure: {"a":1} done', '{"a":', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(documents.salvage_json(F.col("t")))
    assert [r[0] for r in df.collect()] == ['{"a":1}'] * 3 + [None, None]


def test_env(tmp_path, monkeypatch):
    monkeypatch.setenv("FOLIO_B", "kept")
    (tmp_path / ".env").write_text("FOLIO_A='x y'\n# c\nFOLIO_B=new\nexport FOLIO_C=\"z\"\n")
    import os

    assert documents.load_env(str(tmp_path / ".env"))["FOLIO_A"] == "x y"
    assert os.environ["FOLIO_B"] == "kept" and os.environ.pop("FOLIO_A") == "x y" and os.environ.pop("FOLIO_C") == "z"


def test_fetcher():
    waits = []
    clock = [0.0]

    def sleep(s):
        waits.append(s)
        clock[0] += s

    answers = iter([(503, {}, b""), (429, {"Retry-After": "7"}, b""), (200, {}, b'{"a": 1}')])
    f = crawl.Fetcher(lambda u: next(answers), crawl.Limiter(0, lambda: clock[0], sleep), jitter=lambda: 0.5)
    assert f.get_json("u") == {"a": 1} and waits == [1.5, 7.0]
    assert crawl.Fetcher(lambda u: (404, {}, b"")).get_json("u") is None
    try:
        crawl.Fetcher(lambda u: (403, {}, b"")).get_json("u", required=True)
    except crawl.FetchFailed:
        pass
    else:
        raise AssertionError


def test_limiter_spaces_calls():
    clock, waits = [0.0], []

    def sleep(s):
        waits.append(round(s, 3))
        clock[0] += s

    limiter = crawl.Limiter(2, lambda: clock[0], sleep)
    for _ in range(3):
        limiter.wait()
    assert waits == [0.5, 0.5]


def test_graph_store_and_stream(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"))
    assert store.load("folded") is None
    loads = spark.createDataFrame([(1, "k", "N", "ab"), (2, "k", "Name", "abc"), (3, "j", "J", None)], "entity_id bigint, key string, name string, definition string")
    full = loads.select("entity_id", F.lit("m").alias("slug"), "key", "name", F.lit("Tax").alias("type"), "definition", F.array(F.lit("x")).alias("aliases"), F.array(F.lit("s")).alias("section_ids"), F.lit("primary").alias("salience"), F.lit(1).cast("bigint").alias("mentions"), F.lit("m.json").alias("created_from"), F.current_timestamp().alias("loaded_at"))
    src = str(tmp_path / "in")
    full.filter("entity_id < 3").coalesce(1).write.parquet(src)
    full.filter("entity_id > 1").coalesce(1).write.mode("append").parquet(src)
    q = upsert.load_stream(spark, src).writeStream.foreachBatch(upsert.fold_batch(store)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.key: (r.name, r.definition, r.loads) for r in store.load("folded").collect()}
    assert got == {"k": ("Name", "abc", 2), "j": ("J", "", 1)}
    assert {r.key: r.loads for r in folds.entity_upsert(store.load("loads")).collect()} == {"k": 2, "j": 1}
    store.clear()
    assert store.load("folded") is None


def test_paged_listing(spark, tmp_path, monkeypatch):
    module = tmp_path / "fake_service.py"
    module.write_text(
        "import json\nfrom urllib.parse import urlparse, parse_qs\n"
        "DOCS=[{'link':f'/m/{i}','title':f'T{i}','format':'a' if i%2 else 'b'} for i in range(7)]+[{'title':'no link'}]\n"
        "def fetch(url):\n q=parse_qs(urlparse(url).query); s=int(q['start'][0]); n=int(q['count'][0])\n"
        " d=[x for x in DOCS if not q.get('filter_format') or x.get('format')==q['filter_format'][0]]\n return 200, {}, json.dumps({'total':len(d),'results':d[s:s+n]}).encode()\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(module))
    crawl.register(spark)
    df = spark.read.format("paged_listing").option("url", "http://x/search").option("pagesize", "3").option("rps", "0").option("transport", "fake_service.fetch").load()
    assert df.rdd.getNumPartitions() == 3 and sorted(r.link for r in df.collect()) == [f"/m/{i}" for i in range(7)]


def test_second_pass(spark, tmp_path, monkeypatch):
    module = tmp_path / "flaky_service.py"
    seen = tmp_path / "seen"
    seen.mkdir()
    module.write_text(
        "from pathlib import Path\n"
        f"SEEN=Path({str(seen)!r})\n"
        "def fetch(url):\n n=url[-1]\n if n=='0': return 404, {}, b''\n if n=='1': return 403, {}, b''\n"
        " p=SEEN/n\n first=not p.exists(); p.touch()\n return (401, {}, b'') if first and n=='2' else (200, {}, b'{}')\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(module))
    links = spark.createDataFrame([(f"u{i}",) for i in range(5)] + [("u4",), (None,)], "link string")
    got = {r.link: (r.status, r.body, r.error) for r in crawl.fetch_twice(links, "flaky_service.fetch", rps=1000, tasks=2).collect()}
    assert got == {"u0": (404, None, "not_found"), "u1": (403, None, "fetch_failed"), "u2": (200, "{}", None), "u3": (200, "{}", None), "u4": (200, "{}", None)}


def test_the_last_append_wins(spark, tmp_path):
    path = str(tmp_path / "cache")
    for i in range(5):
        documents.append_cache(spark.createDataFrame([("a", str(i)), (f"k{i}", "x")], "key string, result string"), path)
        assert {r.key: r.result for r in documents.latest(documents.read_cache(spark, path)).collect()}["a"] == str(i)


def test_documents_are_skipped_one_by_one(spark, tmp_path):
    out = str(tmp_path / "docs")
    rows = lambda *pairs: spark.createDataFrame([(s, i, t) for i, (s, t) in enumerate(pairs)], "slug string, position int, text string")
    texts = lambda: {r.slug: r.sections[0].text for r in spark.read.json(out).collect()}
    assert documents.write_documents(rows(("a", "1")), out)
    assert documents.write_documents(rows(("a", "2"), ("b b", "2")), out) and texts() == {"a": "1", "b b": "2"}
    assert not documents.write_documents(rows(("a", "3"), ("b b", "3")), out) and not documents.write_documents(rows(("a", "3")).limit(0), out)
    assert documents.write_documents(rows(("a", "4")), out, force=True) and texts() == {"a": "4", "b b": "2"}
    many = str(tmp_path / "lines")
    assert documents.write_documents(rows(("a", "1"), ("a", "2")), many, lines=True) and spark.read.json(many).count() == 2


def test_limit_of_documents(spark, tmp_path):
    for n in "cab":
        (tmp_path / f"{n}.json").write_text(json.dumps({"pages": []}))
    assert sorted(r.slug for r in documents.read_documents(spark, str(tmp_path), limit=2).collect()) == ["a", "b"]
    assert [r.slug for r in documents.read_documents(spark, str(tmp_path), ["C", "b"], limit=1).collect()] == ["b"]


def test_a_save_keeps_the_other_tables(spark, tmp_path):
    import pytest

    store = GraphStore(spark, str(tmp_path / "g"))
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "x string")
    values = lambda name: sorted(r.x for r in store.load(name).collect())
    store.save({"a": frame("1"), "b": frame("2")})
    store.save({"b": frame("3")})
    assert values("a") == ["1"] and values("b") == ["3"] and store.load("c") is None
    with pytest.raises(Exception):  # noqa: B017
        store.save({"a": frame("4"), "b": frame("5").withColumn("y", F.raise_error(F.lit("no")))})
    assert values("a") == ["1"] and values("b") == ["3"]
    store.save({}, {"p": (frame("1", "2").withColumn("part", F.col("x")), "part")})
    store.save({}, {"p": (spark.createDataFrame([("9", "2")], "x string, part string"), "part")})
    assert values("p") == ["1", "9"] and store.load("p", ["1"]).count() == 1 and store.load("p", ["7"]) is None
    store.vacuum()
    assert values("a") == ["1"] and values("b") == ["3"] and values("p") == ["1", "9"]


def test_no_local_checkpoints_on_a_cluster(monkeypatch):
    import pytest

    from foliograph import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        sparkContext = Context()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
