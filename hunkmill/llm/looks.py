"""One form for texts that look the same.

The form keeps what a reader sees and drops how it is encoded: characters that aren't drawn are removed,
line ends become a line feed, compatibility forms without a look of their own (full-width, ligatures,
no-break) are resolved, letters of other scripts become the Latin letter they look like, with whatever
accents they have, spaces, hyphens, colons and slashes of one look become one character, and canonical
composition is applied.  A joiner stays where it makes one picture of two.

A change to the named method: letter case is kept, because here a visibly different case is a
different look.  ``look(text, fold_case=True)`` adds full case folding.

Work is done once per distinct value of a batch, and a text of plain ASCII costs one scan.

Defined results: null stays null; a text without a visible character has the empty form and is in no
pair; raised digits and letters, circled and styled ones, visible accents and other letters stay
distinct; private-use characters stay as they are; lone surrogates can't occur in the tables; texts are processed in
full, whatever their length.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill import workspace

# Letters and marks whose usual drawing is that of a Latin letter or ASCII mark; part of Unicode's
# confusables, without letters that a reader tells apart (as the Greek alpha or the Cyrillic soft sign).
CYRILLIC = "АВЕЅІЈКМНОРСТУХҮѴԌԛԜаеѕіјорсухһԁԛԝүѵӀӏ"
CYRILLIC_AS = "ABESIJKMHOPCTYXYVGqWaesijopcyxhdqwyvIl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳοϲͿϺϜ"
GREEK_AS = "ABEZHIKMNOPTYXCjocJMF"
ARMENIAN = "ՕՏԼՍոսօհ"
ARMENIAN_AS = "OSLUnuoh"
CHEROKEE = "ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏴᏳᏂ"
CHEROKEE_AS = "DRTiAJEWMHYGZbRWSVSLCPKBGh"
LISU = "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"
LISU_AS = "BPDTGKJCZFMNLSRVHWXYAEIOU"
COPTIC = "ⲎⲒⲔⲘⲚⲞⲟⲢⲣⲤⲥⲦⲨⲬ"
COPTIC_AS = "HIKMNOoPpCcTYX"
LATIN = "ɑɡꓸ"
LATIN_AS = "ag."
MARKS = "‐‑﹣－−∕⁄∶꞉․"
MARKS_AS = "-----//::."
#: Kinds of compatibility mapping whose two sides look alike.
ALIKE = {"<wide>", "<narrow>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>"}
# Between these, a joiner makes one picture: people, hands, flags, animals, faces and hearts before it;
# signs, hair, tools, people and the like behind it.
PICTURES = (
    "\u2764\u26d3\u26f9\U0001f344\U0001f34b\U0001f3c2-\U0001f3cc\U0001f3f3\U0001f3f4\U0001f3fb-\U0001f3ff\U0001f408\U0001f415\U0001f426\U0001f43b\U0001f441"
    "\U0001f464-\U0001f487\U0001f48b\U0001f574\U0001f575\U0001f57a\U0001f62e\U0001f635\U0001f636\U0001f642\U0001f645-\U0001f64e\U0001f6a3\U0001f6b4-\U0001f6b6\U0001f91d\U0001f926"
    "\U0001f930-\U0001f93e\U0001f9b8\U0001f9b9\U0001f9cd-\U0001f9df\U0001faf1"
)
JOINED_TO = (
    "\u2194\u2195\u2620\u2640\u2642\u2695\u2696\u26a7\u2708\u2744\u2764\u27a1\u2b1b\U0001f308\U0001f32b\U0001f33e\U0001f373\U0001f37c\U0001f384\U0001f393\U0001f3a4\U0001f3a8"
    "\U0001f3eb\U0001f3ed\U0001f430\U0001f466-\U0001f469\U0001f48b\U0001f4a5\U0001f4a8\U0001f4ab\U0001f4bb\U0001f4bc\U0001f525\U0001f527\U0001f52c\U0001f5e8\U0001f680\U0001f692"
    "\U0001f7e9\U0001f7eb\U0001f91d\U0001f9af-\U0001f9b3\U0001f9ba\U0001f9bc\U0001f9bd\U0001f9d1\U0001f9d2\U0001fa79\U0001faf2"
)
JOINER = "\u200d"
LONE_JOINER = re.compile(f"(?<![{PICTURES}]){JOINER}|{JOINER}(?![{JOINED_TO}])")


def _unseen(ch: str) -> bool:
    """Whether the character is never drawn: format characters, fillers and variation selectors."""
    n = ord(ch)
    if unicodedata.category(ch) == "Cf":
        return not (0x600 <= n <= 0x605 or n in (0x6DD, 0x70F, 0x8E2, 0x110BD, 0x110CD))
    return n in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0x180B <= n <= 0x180F or 0xFE00 <= n <= 0xFE0F or 0xE0100 <= n <= 0xE01EF


@cache
def drawing_tables() -> tuple[dict[int, None], dict[int, str], dict[int, str]]:
    """Code points that aren't drawn; those that are drawn as other text, from the rules above; look-alike letters."""
    gone: dict[int, None] = {}
    table: dict[int, str] = {}
    letters: dict[int, str] = {}
    for source, target in (
        (CYRILLIC, CYRILLIC_AS), (GREEK, GREEK_AS), (ARMENIAN, ARMENIAN_AS), (CHEROKEE, CHEROKEE_AS), (LISU, LISU_AS), (COPTIC, COPTIC_AS), (LATIN, LATIN_AS), (MARKS, MARKS_AS),
    ):
        letters |= dict(zip(map(ord, source), target, strict=True))
    for n in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= n <= 0xF8FF or 0x20000 <= n < 0xE0000 or n >= 0xF0000:
            continue
        ch = chr(n)
        kind = unicodedata.category(ch)
        if kind == "Cn":
            continue
        if _unseen(ch):
            gone[n] = None
        elif kind == "Zs":
            table[n] = " "
        elif kind in ("Zl", "Zp") or n == 0x85:
            table[n] = "\n"
        else:
            tag, _, parts = unicodedata.decomposition(ch).partition(" ")
            if tag in ALIKE:
                made = unicodedata.normalize("NFKC", ch)
                if " " not in made:  # a mark standing alone has no plain counterpart
                    table[n] = made
    del gone[ord(JOINER)]
    return gone, table, letters


@cache
def _by_character() -> tuple[frozenset[str], dict[str, str], dict[str, str], frozenset[str]]:
    """The tables by character, and the characters that have a look-alike letter below their accents."""
    gone, table, letters = drawing_tables()
    below = (chr(n) for n in range(0x80, 0x20000) if not 0xD800 <= n <= 0xF8FF)
    alike = frozenset(c for c in below if any(ord(x) in letters for x in unicodedata.normalize("NFD", c)))
    return frozenset(map(chr, gone)), {chr(n): t for n, t in table.items()}, {chr(n): t for n, t in letters.items()}, alike


def look(text: str, fold_case: bool = False) -> str:
    """The form of one text.

    A text has few different characters beyond ASCII, and only those are looked up and replaced.
    """
    plain = text.isascii()
    if not plain:  # what isn't drawn goes first, so that nothing stands between what belongs together
        gone, table, letters, alike = _by_character()
        used = set(text)
        for c in used & gone:
            text = text.replace(c, "")
        if JOINER in used:
            text = LONE_JOINER.sub("", text)
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if not plain:
        for c in used & table.keys():
            text = text.replace(c, table[c])
        if not alike.isdisjoint(text):  # accents are taken off, so that the letter below them is seen, and put on again
            text = unicodedata.normalize("NFD", text)
            for c in set(text) & letters.keys():
                text = text.replace(c, letters[c])
        text = unicodedata.normalize("NFC", text)
    return text.casefold() if fold_case else text


def _forms(texts: pd.Series, fold_case: bool = False) -> pd.Series:
    codes, distinct = pd.factorize(texts, use_na_sentinel=True)
    forms = pd.Series([look(t, fold_case) for t in distinct] + [None], dtype=object)
    return pd.Series(forms.to_numpy()[codes])


def one_form(text: Column) -> Column:
    """The form as a column expression; runs as an Arrow batch function."""
    return F.pandas_udf(lambda s: _forms(s), "string")(text)  # type: ignore[call-overload]


def same_looks(documents: DataFrame) -> DataFrame:
    """(doc_id, look, raw): 128-bit fingerprints of the form and of the stored text.

    Only texts with a visible character, and only those whose look is shared by two stored texts.
    The count per look combines on the map side: a look that holds a third of all rows sends its
    reducer one row per map task and stored text.
    """
    shaped = documents.select("doc_id", "text", one_form(F.col("text")).alias("form"))
    seen = shaped.where(F.col("form").isNotNull() & F.col("form").rlike(r"[^\s ]"))
    marked = workspace.keep(
        seen.select("doc_id", F.unhex(F.md5("form")).alias("look"), F.unhex(F.md5("text")).alias("raw")), "looks"
    )
    shared = marked.groupBy("look", "raw").agg(F.count("*").alias("n")).groupBy("look").agg(F.count("*").alias("kinds"))
    return marked.join(shared.where("kinds > 1").select("look"), "look", "left_semi").select("doc_id", "look", "raw")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id_a, doc_id_b), doc_id_a < doc_id_b: documents that look the same but are stored differently."""
    alike = workspace.keep(same_looks(workspace.load(spark, sf_dir, "documents")), "alike")
    # stored forms are paired first, so copies of one form never meet each other
    kinds = alike.select("look", "raw").distinct()
    pairs = kinds.toDF("look", "raw_a").join(kinds.toDF("look", "raw_b"), "look").where("raw_a < raw_b")
    a, b = alike.toDF("doc_a", "look", "raw_a"), alike.toDF("doc_b", "look", "raw_b")
    met = pairs.join(a, ["look", "raw_a"]).join(b, ["look", "raw_b"])
    return met.select(F.least("doc_a", "doc_b").alias("doc_id_a"), F.greatest("doc_a", "doc_b").alias("doc_id_b"))


def p8_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, form) of every document."""
    documents = workspace.load(spark, sf_dir, "documents")
    return documents.select("doc_id", one_form(F.col("text")).alias("form"))


def p8_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, class_id, stored_forms): each document's class of equal looks, by its smallest document."""
    documents = workspace.load(spark, sf_dir, "documents")
    marked = documents.select("doc_id", F.md5(one_form(F.col("text"))).alias("look"), F.xxhash64("text").alias("raw"))
    marked = workspace.keep(marked, "looks")
    kinds = marked.groupBy("look", "raw").agg(F.min("doc_id").alias("first"))
    classes = kinds.groupBy("look").agg(F.min("first").alias("class_id"), F.count("*").alias("stored_forms"))
    return marked.join(classes, "look", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("stored_forms", F.lit(1)).alias("stored_forms")
    )


def form_sql(e: str) -> str:
    """DuckDB SQL of the form, written for itself: by code point ranges and by what the documents hold of look-alikes."""
    wide = "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F)))
    alike = "аеорсухѕіјһёїАВЕІЈКМНОРСТХЅЁЇΑΒΕΖΗΙΚΜΝΟΡΤΥΧο‐‑", "aeopcyxsijhëïABEIJKMHOPCTXSËÏABEZHIKMNOPTYXo--"
    e = rf"regexp_replace({e}, '[\x{{ad}}\x{{34f}}\x{{61c}}\x{{180b}}-\x{{180f}}\x{{200b}}\x{{200c}}\x{{200e}}\x{{200f}}\x{{202a}}-\x{{202e}}\x{{2060}}-\x{{206f}}\x{{fe00}}-\x{{fe0f}}\x{{feff}}]', '', 'g')"
    # people with a tool in hand are the only joined pictures
    e = rf"regexp_replace({e}, '([\x{{1f468}}\x{{1f469}}\x{{1f9d1}}])\x{{200d}}([\x{{1f4bb}}\x{{1f527}}\x{{1f52c}}\x{{1f680}}])', '\1' || chr(1114109) || '\2', 'g')"
    e = f"replace(replace({e}, chr(8205), ''), chr(1114109), chr(8205))"
    e = f"replace(replace({e}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    e = rf"regexp_replace(regexp_replace({e}, '[\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}]', ' ', 'g'), '[\x{{85}}\x{{2028}}\x{{2029}}]', chr(10), 'g')"
    e = f"translate({e}, '{wide[0]}', '{wide[1].replace(chr(39), chr(39) * 2)}')"
    for ligature, letters in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        e = f"replace({e}, '{ligature}', '{letters}')"
    return f"nfc_normalize(translate(nfc_normalize({e}), '{alike[0]}', '{alike[1]}'))"


def oracle_sql() -> dict[str, str]:
    forms = f"f as (select doc_id, text, {form_sql('text')} as form from documents)"
    pairs = r"""select a.doc_id as doc_id_a, b.doc_id as doc_id_b from f a join f b on a.form = b.form and a.doc_id < b.doc_id and a.text <> b.text
        where regexp_matches(a.form, '\S')"""
    groups = """c as (select form, min(doc_id) as class_id, count(distinct text) as stored_forms from f where form is not null group by 1)
        select doc_id, coalesce(class_id, doc_id) as class_id, coalesce(stored_forms, 1) as stored_forms from f left join c using (form)"""
    return {"p8_found": f"with {forms} {pairs}", "p8_form": f"with {forms} select doc_id, form from f", "p8_groups": f"with {forms}, {groups}"}
