import random

import pytest

from hunkmill.operators import diffs


SAMPLE = """diff --git a/src/lib.rs b/src/lib.rs
index 1..2 100644
--- a/src/lib.rs
+++ b/src/lib.rs
@@ -10,3 +10,4 @@ impl Widget {
 fn a() {
-    old();
+    new();
+    more();
 }
diff --git a/README.md b/README.md
new file mode 100644
--- /dev/null
+++ b/README.md
@@ -0,0 +1,2 @@
+# Hi
+there
\\ No newline at end of file
"""
# by hand: a diff, its files (path, old path, status, binary, hunks), its numbered lines (file, hunk, kind, old, new, text)
HAND = [
    (
        SAMPLE,
        [("src/lib.rs", None, "modified", False, 1), ("README.md", None, "added", False, 1)],
        [
            (1, 1, "ctx", 10, 10, "fn a() {"), (1, 1, "del", 11, None, "    old();"), (1, 1, "add", None, 11, "    new();"), (1, 1, "add", None, 12, "    more();"),
            (1, 1, "ctx", 12, 13, "}"), (2, 1, "add", None, 1, "# Hi"), (2, 1, "add", None, 2, "there"),
        ],
    ),
    # inside a hunk, lines that look like path headers are read as path headers
    (
        "diff --git a/x b/y\n--- a/x\n+++ b/y\n@@ -1 +1 @@\n-- deleted comment\n--- gone\n+++ came\n x\n",
        [("came", "gone", "renamed", False, 1)],
        [(1, 1, "del", 1, None, "- deleted comment"), (1, 1, "ctx", 2, 1, "x")],
    ),
    ("@@ -1,2 +1,2 @@\n x\n", [], []),  # no file
    (
        "diff --git a/x b/x\r\n--- a/x\r\n+++ b/x\r\n@@@ -1,2 -1 +3,4 @@@ z\r\n a\r\n\r\n+b\r\n",
        [("x", None, "modified", False, 1)],
        [(1, 1, "ctx", 1, 3, "a"), (1, 1, "ctx", 2, 4, ""), (1, 1, "add", None, 5, "b")],
    ),
    ("diff --git a/x.png b/x.png\nBinary files a/x.png and b/x.png differ\n", [("x.png", None, "modified", True, 0)], []),
    (
        "diff --git a/x b/x\n--- a/x\n+++ /dev/null\n@@ -1,2 +0,0 @@\n-a\n-b\n",
        [("x", "x", "deleted", False, 1)],
        [(1, 1, "del", 1, None, "a"), (1, 1, "del", 2, None, "b")],
    ),
    ("diff --git a/a/x\n@@ q @@\n+1\n", [("x", None, "modified", False, 1)], [(1, 1, "add", None, 0, "1")]),
    ("", [], []),
    (None, [], []),
]


def soup(rng):
    pool = ["diff --git a/p b/p", "diff --git a/q b/r", "--- a/p", "--- /dev/null", "+++ b/p", "+++ b/z", "+++ /dev/null", "@@ -1,2 +3,4 @@", "@@ -7 +9 @@ f", "+x", "-y", " c", "\\ No newline", "", "-- k", "++ k", "Binary files a and b differ", "index 1..2"]
    return "diff --git a/0 b/0\n" + "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))


def test_by_hand(spark):
    df = spark.createDataFrame([(k, case[0]) for k, case in enumerate(HAND)], "doc bigint, diff string")
    lines = diffs.lines_of(df, "doc", "diff").cache()
    files = diffs.files(lines).orderBy("doc", "f").collect()
    numbered = diffs.numbered(lines).orderBy("doc", "f", "h", "pos").collect()
    for doc, (_, in_files, in_lines) in enumerate(HAND):
        assert [(r.path, r.old_path, r.status, r.binary, r.hunks) for r in files if r.doc == doc] == in_files
        assert [(r.f, r.h, r.kind, r.old_no, r.new_no, r.text) for r in numbered if r.doc == doc] == in_lines


def test_what_holds_for_every_diff(spark):
    """Hunks open with their header and hold their lines verbatim and in order; both sides are counted without a gap."""
    rng = random.Random(5)
    cases = [soup(rng) for _ in range(250)]
    df = spark.createDataFrame(list(enumerate(cases)), "doc bigint, diff string")
    lines = diffs.lines_of(df, "doc", "diff").cache()
    hunks = diffs.hunks(lines).orderBy("doc", "f", "h").collect()
    numbered: dict = {}
    for r in diffs.numbered(lines).orderBy("doc", "f", "h", "pos").collect():
        numbered.setdefault((r.doc, r.f, r.h), []).append(r)
    opened = [sum(line.startswith("@@") for line in case.split("\n")) for case in cases]
    assert [sum(x.doc == d for x in hunks) for d in range(len(cases))] == opened
    for x in hunks:
        given, own = iter(cases[x.doc].split("\n")), x.raw.split("\n")
        assert all(line in given for line in own) and own[0] == x.header and x.header.startswith("@@")
        body, rows = [line for line in own[1:] if line[:1] != "\\"], numbered.get((x.doc, x.f, x.h), [])
        assert [r.text for r in rows] == [line[1:] if line[:1] in "+- " else line for line in body]
        assert [r.kind for r in rows] == [{"+": "add", "-": "del"}.get(line[:1], "ctx") for line in body]
        old, new = [r.old_no for r in rows if r.kind != "add"], [r.new_no for r in rows if r.kind != "del"]
        assert old == list(range(x.old_start, x.old_start + len(old))) and new == list(range(x.new_start, x.new_start + len(new)))
        assert all((r.old_no is None) == (r.kind == "add") and (r.new_no is None) == (r.kind == "del") for r in rows)
        assert x.last_new == max([x.new_start, *new])


def test_sample(spark):
    lines = diffs.lines_of(spark.createDataFrame([(1, SAMPLE)], "doc int, diff string"), "doc", "diff")
    got = {(r.path, r.status) for r in diffs.files(lines).collect()}
    assert got == {("src/lib.rs", "modified"), ("README.md", "added")}
    adds = [r.new_no for r in diffs.numbered(lines).where("kind = 'add' and f = 1").orderBy("pos").collect()]
    assert adds == [11, 12]
    assert diffs.hunks(lines).where("f = 1").first().last_new == 13


@pytest.mark.parametrize("extra", [["x int"], []])
def test_empty_table(spark, extra):
    df = spark.createDataFrame([], ", ".join(["doc bigint", "diff string", *extra]))
    lines = diffs.lines_of(df, "doc", "diff")
    assert diffs.files(lines).count() == diffs.hunks(lines).count() == diffs.numbered(lines).count() == 0
