"""Chains of renames against a walk in plain Python, and links after them."""

import random

from kasane.operators import renames


def walked(pairs):
    """{old: (new, steps, status)} by following each name."""
    step = {}
    for old, new in pairs:
        if old is not None and new is not None and old != new:
            step[old] = min(new, step.get(old, new))
    out = {}
    for old in step:
        seen, at = {old}, step[old]
        while at in step and at not in seen:
            seen.add(at)
            at = step[at]
        out[old] = (old, 0, "cycle") if at in seen else (at, len(seen), "renamed")
    return out


def test_followed_against_a_walk(spark):
    rng = random.Random(6)
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(200)]  # one chain of 200
    pairs += [(f"c{i}", f"c{(i + 1) % 7}") for i in range(7)] + [("into", "c3"), ("before", "into")]  # a circle, and names that lead into it
    pairs += [(f"r{rng.randrange(60)}", f"r{rng.randrange(90)}") for _ in range(70)]
    pairs += [("x", "x"), (None, "y"), ("z", None), ("twice", "b"), ("twice", "a"), ("twice", "a")]
    got = renames.followed(spark.createDataFrame(pairs, "old string, new string").repartition(3)).collect()
    assert {r.old: (r.new, r.steps, r.status) for r in got} == walked(pairs) and len(got) == len(walked(pairs))
    assert renames.followed(spark.createDataFrame([], "old string, new string")).collect() == []


def test_aliases_and_links(spark):
    ends = renames.followed(spark.createDataFrame([("laws/a/x.md", "laws/a/y.md"), ("laws/a/y.md", "laws/b/z.md"), ("laws/a/p.md", "laws/a/q.md"), ("laws/o.md", "laws/o2.md"), ("laws/o2.md", "laws/o.md")], "old string, new string"))
    assert {r.name: r.aliases for r in renames.aliases(ends).collect()} == {"laws/b/z.md": ["laws/a/x.md", "laws/a/y.md"], "laws/a/q.md": ["laws/a/p.md"]}
    body = "[[laws/a/x|X]] [[laws/a/x.md]] [[y.md#第1項|第1項]] [[p]] [[laws/o.md|stays]] [[laws/a/none.md]] [[https://laws/a/x.md]] [[#here]] [[laws/a/x.md|X]]\n$1 \\ [ ]]"
    files = spark.createDataFrame([("laws/a/f.md", body, 7), ("laws/a/p.md", "no link", 8), ("laws/n.md", None, 9), ("laws/b/z.md", "[[p]]", 10)], "path string, body string, size int")
    got = {r.old_path: (r.path, r.body, r.size, r.n_changed) for r in renames.relocated(files, ends).collect()}
    new = "[[laws/b/z|X]] [[laws/b/z.md]] [[laws/b/z.md#第1項|第1項]] [[laws/a/q]] [[laws/o.md|stays]] [[laws/a/none.md]] [[https://laws/a/x.md]] [[#here]] [[laws/b/z.md|X]]\n$1 \\ [ ]]"
    assert got == {"laws/a/f.md": ("laws/a/f.md", new, 7, 5), "laws/a/p.md": ("laws/a/q.md", "no link", 8, 0), "laws/n.md": ("laws/n.md", None, 9, 0), "laws/b/z.md": ("laws/b/z.md", "[[p]]", 10, 0)}
    checked = {r.run: (r.n_links, r.n_broken) for r in renames.verified(files, renames.relocated(files, ends), ["laws"]).collect()}
    assert checked == {"before": (8, 7), "after": (8, 3)}
