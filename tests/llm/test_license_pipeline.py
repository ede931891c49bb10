import os
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from courtside.llm import catalog, license_scan as L
from courtside.llm.common import staged, table

SF = "/root/testdata/sf0.001"


def found(df, keep=("doc_id",)):
    return {r["doc"]["doc_id"]: (r["text_license"], r["notices"]) for r in L.scan(df, list(keep)).collect()}


def test_whole_texts_and_lines(docs_of):
    mit, isc = L.TEXTS[0][1], L.TEXTS[1][1]
    texts = {1: mit, 2: "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace("\n", " \r\n\t"),
             3: "The text.\n  Released under the MIT Licence!\nmore", 4: "Released under the MIT License. And more.",
             5: "© 2019-2021 X\nAll rights reserved.\nThis work is licensed under the GNU General Public License, version 3.",
             6: "licensed under CC BY-NC 4.0\nLicensed under the Apache License, Version 2.0.\nlicensed under cc by-nc 4.0",
             7: mit + "\nand one word", 8: "copyright 2020 x", 9: isc.replace("notice and this", "notice, and this")}
    got = found(docs_of([(i, t, *[None] * 8) for i, t in texts.items()]))
    assert got == {1: ("MIT", ""), 2: ("MIT", ""), 3: (None, "MIT"), 4: (None, ""), 5: ("GPL-3.0", "GPL-3.0"),
                   6: (None, "Apache-2.0,CC-BY-NC-4.0"), 7: (None, ""), 8: (None, ""), 9: ("ISC", "")}


def test_titled_files(docs_of):
    """A licence file: title, copyright line, text; every listed licence but those stated as missing."""
    bodies = defaultdict(list)
    for key, own, body in L.bodies():
        bodies[key].append((own, body))
    assert set(bodies) == {k for k, _ in L.NAMES} - set(L.MISSING)
    rows, want = [], {}
    for key, titles in ((k, (*names, *L.TITLES.get(k, ()))) for k, names in L.NAMES if k in bodies):
        own, body = bodies[key][-1]
        for head in (*titles, "\n  ".join(own)):
            want[len(rows)] = key
            rows.append((len(rows), f"  {head}\n\nCopyright (c) 2021 Some Body\n\n{body}\n", *[None] * 8))
    got = found(docs_of(rows))
    assert {i: got[i][0] for i in want} == want
    mit = L.TEXTS[0][1]
    assert found(docs_of([(1, "The MIT License (MIT)\n\nCopyright (c) 2020 X\n\n" + mit, *[None] * 8),
                          (2, "The MIT License (MIT)\nother", *[None] * 8)])) == {1: ("MIT", "MIT"), 2: (None, "MIT")}


def test_odd_rows(docs_of, odd_rows):
    df = docs_of(odd_rows)
    assert L.scan(df, df.columns).select("doc.*").columns == df.columns
    assert L.scan(df, ["doc_id"]).count() == len(odd_rows)
    assert set(found(df).values()) == {(None, "")} and found(docs_of([])) == {}


def test_known_entries_are_distinct(spark):
    assert L.known_digests(spark).count() >= len({k for k, _ in L.known_entries()})
    by = defaultdict(set)
    for k, t in L.known_entries():
        by[t].add(k)
    assert all(len(v) == 1 for v in by.values())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql_twin(spark, name):
    got = catalog.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(catalog.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert Counter(map(tuple, got.select(cols).collect())) == Counter(want.select(*cols).fetchall())


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    seen = {r["doc_id"] for r in docs.select("doc_id").collect()}
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = staged(stage(spark, docs, sf))
        ids = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        assert ids and set(ids) <= seen
        if n < 4:
            assert docs.columns == columns
        if n < 3:
            assert max(ids.values()) == 1 and 0.5 * len(seen) < len(ids) < len(seen), name
        seen = set(ids)
    pieces = docs.collect()
    size = Counter()
    for p in pieces:
        size[p["sequence_id"]] += p["length"]
    assert all(s == 4096 or s & (s - 1) == 0 for s in size.values())


def test_pipeline_runs_whole(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and len(corpus_pipeline.STAGES) == 5


def test_entry_registers_the_operators():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names
    assert set(catalog.ORACLE_SQL) <= set(entry.oracle_sql())
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "corpus_pipeline.py"))
