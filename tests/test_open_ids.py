"""Pending ids over several micro-batches: replays, late resolutions, timers, and state that is let go."""

import json
from datetime import timedelta

from kasane.streaming import open_ids


def test_open_resolved_overdue(spark, tmp_path):
    folders = [tmp_path / "pending", tmp_path / "resolved"]
    for f in folders:
        f.mkdir()
    read = lambda f, schema: spark.readStream.schema(schema).json(f"file://{f}")
    changes = open_ids.changes(read(folders[0], "id string, ts string, kind string"), read(folders[1], "id string, ts string"), timedelta(days=2), timedelta(days=5), "1 hour")
    seen = []

    def land(batch, pending=(), resolved=()):
        for folder, rows in zip(folders, (pending, resolved)):
            if rows:
                (folder / f"{batch}.json").write_text("\n".join(json.dumps(r) for r in rows))
        at = f"file://{tmp_path}/check"
        query = changes.writeStream.foreachBatch(lambda df, _: seen.extend((batch, r.id, r.status, r.kind, str(r.at), r.waited_s) for r in df.collect())).option("checkpointLocation", at).outputMode("update").trigger(availableNow=True).start()
        query.awaitTermination(180)
        states = spark.read.format("statestore").option("stateVarName", "id").load(at).select("key.id").collect()
        new = sorted(x[1:] for x in seen if x[0] == batch)
        return new, sorted(r.id for r in states)

    day = lambda d, h=0: f"2024-01-{d:02} {h:02}:00:00"
    p = lambda i, d, h=0: {"id": i, "ts": day(d, h), "kind": f"k{i}"}
    r = lambda i, d, h=0: {"id": i, "ts": day(d, h)}
    assert land(1, [p("a", 1), p("a", 1, 5), p("b", 1), {"id": None, "ts": day(1)}], [r("z", 1)]) == ([("a", "open", "ka", day(1), 0), ("b", "open", "kb", day(1), 0)], ["a", "b", "z"])
    assert land(2, [p("a", 2), p("z", 2)], [r("a", 2, 6), r("a", 2, 7)]) == ([("a", "resolved", "ka", day(2, 6), 30 * 3600)], ["a", "b", "z"])  # replay of a, z resolved before
    new, held = land(3, [p("c", 4)])  # b is overdue on the third
    assert new == [("b", "overdue", "kb", day(3), 2 * 86400), ("c", "open", "kc", day(4), 0)] and held == ["a", "b", "c", "z"]
    assert land(4, [], [r("b", 4, 3)])[0] == [("b", "resolved", "kb", day(4, 3), 3 * 86400 + 3 * 3600)]
    new, held = land(5, [p("d", 20)])
    assert new == [("c", "overdue", "kc", day(6), 2 * 86400), ("d", "open", "kd", day(20), 0)] and set(held) <= {"c", "d"}
    new, held = land(6, [p("e", 27), p("a", 27)])  # a is forgotten, so it is opened anew
    assert ("a", "open", "ka", day(27), 0) in new and ("d", "overdue", "kd", day(22), 2 * 86400) in new and "b" not in held and "z" not in held
