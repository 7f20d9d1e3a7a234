"""What the corpus operators cost: tasks, rows and memory, beside results."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from conftest import settings

from listenlake.llm import components, line_dedup, near_dedup, phrases

UNCOALESCED = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def tasks_of(spark, group, run):
    """What ``run`` gives, and the number of tasks that it took."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        found = run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    stages = {s for job in status.getJobIdsForGroup(group) for s in status.getJobInfo(job).stageIds}
    return found, sum(info.numCompletedTasks for s in stages if (info := status.getStageInfo(s)))


def test_components_of_few_edges_take_few_tasks(spark):
    """Rounds cost by their edges: 211 partitions that are not coalesced made thousands of tasks of no edges."""
    edges = [(x, x + 1) for x in range(1, 40)] + [(100, x) for x in range(101, 120)] + [(7, 7), (40, 39)]
    frame = spark.createDataFrame(edges, "a long, b long")
    with settings(spark, UNCOALESCED):
        rows, tasks = tasks_of(spark, "components", lambda: components.components(frame).collect())
    assert {r.node: r.component for r in rows} == {**{x: 1 for x in range(1, 41)}, **{x: 100 for x in range(100, 120)}}
    assert tasks < 400


def test_union_find_gives_its_forest_before_it_grows_too_large(monkeypatch):
    monkeypatch.setattr(components, "NODES_AT_ONCE", 3, raising=False)
    rows = [pd.DataFrame({"a": [1, 2], "b": [2, 3]}), pd.DataFrame({"a": [4, 5], "b": [5, 6]}), pd.DataFrame({"a": [3], "b": [4]})]
    found = [list(zip(f["a"], f["b"], strict=True)) for f in components._union_find(iter(rows))]
    assert found == [[(1, 2), (1, 3), (4, 5), (4, 6)], [(3, 4)]]


def test_near_duplicates_with_broadcast_and_joined_sketches_agree(spark, monkeypatch):
    """Links that only members outside the largest group of a band have, by both ways to hold them against each other."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:k], *(f"x{k}{i}" for i in range(60 - k)), *words]) for k in range(20, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = []
    for most in (40_000, -1):
        monkeypatch.setattr(near_dedup, "BROADCAST_SKETCHES", most, raising=False)
        found.append(sorted(tuple(r) for r in near_dedup.near_duplicates(docs).collect()))
    assert found[0] == found[1] and len({row[2] for row in found[0]}) > 1


def test_codes_of_words_pass_through_spark_as_bytes():
    """Elements of arrays were converted one by one, by every scan again."""
    texts = ["b a. b", "c", "a"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["x", "x", "y"]), pa.array([0, 0, 0], pa.int32())], names=["text", "lang", "shard"])
    (rows,) = phrases._encode(0)(iter([batch]))
    assert pa.types.is_binary(rows.schema.field("codes").type) and pa.types.is_binary(rows.schema.field("numbers").type)
    coded = rows.filter(pa.compute.not_equal(rows["shard"], phrases.DICTIONARY)).select(["lang", "codes", "numbers"])
    number = {word: np.uint64(xxhash.xxh64_intdigest(word, 0)).astype(np.int64) for word in "abc"}
    found = {lang: [numbers[i] if i >= 0 else None for i in at] for lang, at, numbers in phrases._by_language(iter([coded]))}
    a, b, c = (number[word] for word in "abc")
    assert found == {"x": [b, a, None, b, None, c, None], "y": [a, None]}


def test_texts_without_repeated_lines_are_not_sent_to_python_again(spark, monkeypatch):
    """Only texts that lose words are taken apart; the others' lines are counted by Spark, whether runs are broadcast or shuffled."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, passage), (2, f"one\n\n x  y {passage}  z\tz \nlast"), (3, "a\nb\n"), (4, None), (5, ""), (None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = [
        (None, passage, 1, 0, "", 0),
        (1, passage, 1, 0, "", 0),
        (2, "one\n\nx  y z\tz\nlast", 4, 0, "", 60),
        (3, "a\nb\n", 3, 0, "", 0),
        (4, None, 1, 0, "", 0),
        (5, "", 1, 0, "", 0),
    ]
    for most in (200_000, -1):
        monkeypatch.setattr(line_dedup, "BROADCAST_DOCS", most)
        found = line_dedup.drop_repeated_lines(docs)
        assert "Union" in found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, found.collect()), key=lambda r: (r[0] is not None, r[0])) == expected


def test_marks_and_spans_pass_through_spark_as_bytes():
    """Elements of lists of structs were converted one by one, though most of them stand once."""
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 2]), pa.array(["a b", " ".join(map(str, range(70)))])], names=["doc_id", "version", "text"])
    (rows,) = line_dedup._read_borders(50)(iter([batch]))
    assert rows["doc_id"].to_pylist() == [2] and pa.types.is_binary(rows.schema.field("marks").type)
    marks, spans = (np.frombuffer(rows[c][0].as_py(), kind) for c, kind in (("marks", line_dedup._MARK), ("spans", line_dedup._SPAN)))
    assert marks["n"].sum() == 21 and spans["first"].min() == 0 and spans["stop"].max() == 70
    assert rows["hashes"][0].as_py() == [*marks["hash"], *spans["hash"]]
