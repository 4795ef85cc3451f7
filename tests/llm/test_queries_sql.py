"""The numbered queries against their SQL, on the smallest tables, and what is registered."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from docsieve.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_same_rows(spark, tables, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), tables, queries.SQL[name]) == []


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
    assert "pipeline" in names


def stored(folder, **tables):
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")
    return str(folder)


def test_cutoffs_come_into_play(spark, tmp_path):
    """900 good documents of one language admit cutoffs, 60 of another do not; both sides agree on each row."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 7)))
    rows, labels = [], []
    for i in range(1200):
        lang = "en" if i < 1000 else "de"
        words = [word() for _ in range(rng.randint(55, 80))]
        good = i < 900 or 1000 <= i < 1060
        if not good or i % 300 == 0:
            # Many symbols, which good documents hardly have, or lines that come again.
            words += ["#|"] * 40 if i % 2 else ["\nsame line here"] * 12
        rows.append((i, " ".join(words), lang))
        if good:
            labels.append((i, 1))
    labels += [(1195, 0), (None, 1), (3, None)]
    folder = stored(
        tmp_path,
        documents={"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "lang": [r[2] for r in rows]},
        labels={"doc_id": pa.array([x[0] for x in labels], pa.int64()), "quality": pa.array([x[1] for x in labels], pa.int64())},
    )
    found = queries.op4_quality_rules(spark, folder)
    assert compare(found, connect(folder), queries.SQL["op4_quality_rules"]) == []
    dropped = {r["doc_id"] for r in found.where("NOT base_failed AND NOT kept").collect()}
    assert len(dropped) >= 40 and all(i < 1000 for i in dropped)
    # No more than the stated share of the good documents may go.
    assert sum(i < 900 for i in dropped) <= 0.05 * 900


def test_license_names_that_run_on_are_found_by_both(spark, tmp_path):
    texts = [
        "Licensed under the GPLv2", "Licensed under the GPL v2 and, apache2 license", "FreeBSD license text", "under the MIT license",
        "either version 2 of the license or at your option any later version", "gnu either version 2 of the license or at your option any later version",
        None, "", "CC-BY-NC, cc by nc", "licensed under agplv3; apache license version 2",
    ]
    folder = stored(tmp_path, documents={"doc_id": list(range(len(texts))), "text": texts})
    found = queries.op6_license_scan(spark, folder)
    assert compare(found, connect(folder), queries.SQL["op6_license_scan"]) == []
    labels = {r["doc_id"]: r["labels"] for r in found.collect()}
    assert labels[0] == "gpl-2" and labels[6] == ""
