import pytest

from hunkmill.llm import pairs

PROMPT = "Repository: o/n\nPull request: #1\nFile: src/a.rs\n\n```diff\n@@ -1,3 +1,4 @@\n fn load_graph(x: &Edge) {\n-    let old = shard.read();\n+    let fresh = shard.write()?;\n+    fresh.check();\n }\n```"
DIFF = PROMPT.split("```diff\n")[1].removesuffix("\n```")


@pytest.mark.parametrize(
    "answer", [None, "", " ", "\n\t", " ", "​​", "&nbsp;", "```\n```", "> ", "**  **", "---", "...", "<!-- a\nb -->", "<br>", "[//]: # (x)", "_ _"]
)
def test_empty(answer):
    assert pairs.judge(PROMPT, answer, None)[0] == ["empty"]


@pytest.mark.parametrize("answer", ["OK", "👍", "+1", "lgtm!", "Yep", "ditto", "> let old = shard.read();\n\nWhy drop it?", "Makes sense to me", "?"[:0] + "Nit: typo in `x`"])
def test_replies_are_answers(answer):
    assert pairs.judge(PROMPT, answer, None)[0] == []


@pytest.mark.parametrize(
    "answer", [PROMPT, DIFF, "> " + PROMPT.replace("\n", "\n> "), PROMPT.replace("\n", " "), "Here is the change:\n\n" + DIFF, "\n".join(x[1:] if x[:1] in "+-" else x for x in DIFF.split("\n"))]
)
def test_copied(answer):
    assert pairs.judge(PROMPT, answer, None)[0][0] == "copied"


@pytest.mark.parametrize(
    "answer",
    [
        "I'm sorry, but I can’t help with reviewing this code.", "As an AI language model, I am not permitted to discuss this file.", "I must decline to answer this. My policies do not allow it.",
        "Reviewing this patch is beyond my capabilities.", "It is not possible for me to review diffs.", "Es tut mir leid, aber ich kann diesen Code nicht bewerten.", "Lo siento, pero no puedo ayudar con esta revisión.",
        "I am unable to do a review at this time.", "Leider kann ich dabei nicht behilflich sein", "Beklager, men jeg kan ikke hjelpe med denne koden.",
        "Üzgünüm, bu kodu inceleyemem.", "Tyvärr kan jag inte granska den här koden.", "Je dois refuser cette demande.", "Не можу допомогти з цим кодом.", "آسف، لا أستطيع مساعدتك.",
        "Thank you for sharing this change. I cannot review it. " + "A review asks for the judgment of people who know the project, so please ask a maintainer of it. " * 8,
        "I can't help with reviewing this code:\n\n> let old = shard.read();\n> let fresh = shard.write()?;\n\nPlease ask one of the maintainers.",
        "Desculpe, não posso comentar este código.", "Je suis désolé, je ne peux pas commenter ce code.", "К сожалению, я не могу помочь с этим кодом.", "抱歉，我无法评论这段代码。", "申し訳ありませんが、このコードをレビューできません。",
    ],
)
def test_refusals(answer):
    assert pairs.judge(PROMPT, answer, None)[0][0] == "refusal"


@pytest.mark.parametrize(
    "answer",
    [
        "We cannot accept each hunk here, `x` has to reject it.", "I can't help but notice that `a` and `b` share a lock.", "I'm unable to reproduce the old page with `x` on 22 rows, which seed did you use?",
        "I can't comment on the naming but the lock is wrong.", "I would rather not review this style; drop it.",
        "I'm not able to complete the build with this change; it fails on Windows.", "The guard is held too long. I can't review the rest today.",
        "Sorry, I can't see why `X` needs to be public, could it stay in `y`?", "It is against the policy of `x` to let `y` return it.", "I won't block on this, but the name still surprises callers of `x`.",
    ],
)
def test_remarks_are_no_refusals(answer):
    assert pairs.judge(PROMPT, answer, None)[0] == []


@pytest.mark.parametrize(
    "answer, bad",
    [
        ("Die Funktion `x` hält die Sperre länger als nötig, und dafür fehlt noch ein Test.", True),
        ("Hi! Le module `a` est déjà présent dans une autre couche, et il manque un test.", True),
        ("El tipo `T` pierde el error original, y se nota a partir de 188 filas.", True),
        ("O módulo `m` perde o erro original, seria melhor separar as duas etapas.", True),
        ("Модуль `m` теряет исходную ошибку.", True), ("类型 `T` 混合了两个不同的职责。", True), ("型 `T` は二つの責務を混ぜています。", True),
        ('The fixture says "файл не найден" but `x` compares it with the store.', False), ("The string `これはテストです` in `y` breaks it, is that intended?", False),
        ("The São Paulo half of `a` never worked with our cache.", False),
    ],
)
def test_language(answer, bad):
    assert ("language" in pairs.judge(PROMPT, answer, None)[0]) == bad


def test_short_diffs_and_short_answers():
    prompt = "File: a\n\n```diff\n+x y\n```"
    assert pairs.judge(prompt, "+x y", None)[0] == ["copied"] and pairs.judge(prompt, "x y", None)[0] == ["copied"]
    assert pairs.judge(prompt, "Use x here", None)[0] == pairs.judge(prompt, "lgtm", None)[0] == []
    assert pairs.judge("File: a\n\n```diff\n```", "Fine.", None)[0] == []


def test_every_turn_is_judged(spark):
    good = "The outer guard keeps the fragile buffer while the caller reads the index."
    say = [("system", "s"), ("user", PROMPT), ("assistant", good), ("user", "And the other file?"), ("assistant", "I must decline to answer this."), ("assistant", " "), ("assistant", None)]
    two = [("user", "x"), ("assistant", good), ("user", PROMPT), ("assistant", DIFF), None, ("tool", "y")]
    before = [("assistant", DIFF), ("user", PROMPT)]
    df = spark.createDataFrame([(1, say), (2, two), (3, before), (None, before), (4, []), (5, [("user", "x"), ("assistant", good)])], f"record_id bigint, messages {M}")
    got = {r.record_id: r.defects for r in pairs.flag_pairs(df).collect()}
    assert got == {1: ["empty", "refusal"], 2: ["copied"], 3: ["copied"], None: ["copied"], 4: ["empty"]}


def test_types_of_the_smaller_table(spark):
    """By hand: what the answers of the table of scale 0.01 are that differ from the comment they were built from."""
    expected = {
        "empty": [73, 121, 190, 254, 381, 442, 469, 481],
        "copied": [224, 337, 339, 356, 448, 475],
        "refusal": [129, 146, 173, 186, 328, 336],
        "language": [85, 161, 215, 268, 296, 343],
        "truncated": [3, 33, 81, 228, 266, 281, 363, 399, 401, 493],
    }
    got = pairs.p3_found(spark, "/root/testdata/sf0.01").collect()
    assert sorted((r.record_id, r.defect) for r in got) == sorted((k, d) for d, ids in expected.items() for k in ids)


def test_prompt_language_is_taken_from_the_prompt():
    said = "Die Funktion `x` hält die Sperre länger als nötig, und dafür fehlt noch ein Test."
    assert "language" not in pairs.judge("Bitte lies die Änderung und sag, was nicht gut ist. Das ist die Datei, die wir prüfen.", said, None)[0]


@pytest.mark.parametrize(
    "answer", ["See ```\nlet x =", "Compare `retry_comm", "This holds (see also", "One.\n2. Two.\n3.", "text <!-- and", "Why not,", "Fix `a` so that:"]
)
def test_open_endings(answer):
    assert pairs.ending(answer)[0] == "open"


@pytest.mark.parametrize("answer", ["Done.", "Is it? 🚀", "See https://h/x#1", "Use `x`", "```\nx\n```", "a :) b.", "It is one of those.", "> quoted line"])
def test_closed_endings(answer):
    assert pairs.ending(answer)[0] == "closed"


M = "array<struct<role: string, content: string>>"


def test_table(spark):
    say = lambda a: [("system", "Be kind to the people of the project and say what you think."), ("user", PROMPT), ("assistant", a)]
    full = "The outer guard of `x` keeps the fragile buffer while the caller reads the index."
    rows = [(k, say(f"{full} Case {k} is about the method in the module.")) for k in range(60)]
    rows += [(100, say("The outer guard keeps the fragile buffer while the caller reads the")), (101, say("The outer guard keeps the fragile buffer while the caller reads the ind"))]
    rows += [(102, say("The outer guard keeps the fragile buffer while the caller reads the index")), (103, None), (104, [None, ("user", PROMPT)]), (105, say(full * 3000)), (106, say(None))]
    rows += [(107, say(DIFF)), (107, say(DIFF))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"record_id bigint, messages {M}, word string, n int")
    got = sorted((r.record_id, tuple(r.defects)) for r in pairs.flag_pairs(df).collect())
    assert got == [(100, ("truncated",)), (101, ("truncated",)), (103, ("empty",)), (104, ("empty",)), (106, ("empty",)), (107, ("copied",)), (107, ("copied",))]
    assert pairs.flag_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize("times", [1, 100])
def test_cut_off_words_are_found_at_any_size(spark, times):
    """A part of a word that is also used alone, a few times or once at a sentence's end; and a plain word that has longer ones."""
    say = lambda a: [("user", PROMPT), ("assistant", a)]
    rows = [(k, say("The default of the caller is derived from the deferred index, and we see the action of the caller.")) for k in range(60 * times)]
    rows += [(1000_000 + k, say("The der value of the caller is read by the index.")) for k in range(4 * times)]
    rows += [(2000_000 + k, say("They all wait for the lock and then they act.")) for k in range(6 * times)]
    ends = ["The outer guard keeps what the caller turns into the der", "The outer guard keeps it until the callers act"]
    if times > 1:
        rows.append((3000_000, say("Some people would rather call it a def.")))
        ends.append("The outer guard keeps the value that we forget in def")
    rows += [(-1 - k, say(a)) for k, a in enumerate(ends)]
    df = spark.createDataFrame(rows, f"record_id bigint, messages {M}")
    got = {r.record_id: r.defects for r in pairs.flag_pairs(df).collect()}
    assert got == {k: ["truncated"] for k in ((-1, -3) if times > 1 else (-1,))}


def test_a_table_without_determiners(spark):
    df = spark.createDataFrame([(1, [("user", PROMPT), ("assistant", "Callers keep index values while readers wait")])], f"record_id bigint, messages {M}")
    assert pairs.flag_pairs(df).count() == 0


def test_a_refusal_in_another_language_has_both_defects():
    said = "Es tut mir leid, aber ich kann diesen Code nicht bewerten, und das ist auch nicht meine Aufgabe."
    assert pairs.judge(PROMPT, said, None)[0] == ["refusal", "language"]
    assert pairs.judge(PROMPT, "I must decline to answer this. My policies do not allow it.", None)[0] == ["refusal"]
