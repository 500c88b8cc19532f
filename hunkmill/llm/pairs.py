"""Broken prompt and response pairs.

Ordered rules look at every assistant message of a record, with the user message before it (the first one, if
none is before it):

1. ``empty``: no assistant message, or nothing in one that a reader would see.
2. ``copied``: the words are those of the user message or of its diff, whole or nearly.
3. ``refusal``: a clause declines, in one of several languages, and all other clauses talk about that only.
4. ``language``: the script or the function words are those of another language than the prompt's.
5. ``truncated``: a delimiter stays open, or the text ends where no sentence can end.

The last rule uses the corpus: how often, over all answers, a word ends a sentence, by itself and behind
a determiner, beside the corpus's own share, and how rare it is beside the longer words that begin with it.
These are ratios, so that a table's size doesn't matter.  Only the last words of answers without a final
mark are looked up, in counts that are aggregated on the map side and joined, so their number is no matter.

``flag_pairs`` emits every triggered defect of every turn; ``p3_found`` keeps the first, as the rules are ordered.
No rule depends on how many records there are, or on an answer's length but that short replies need no full sentence.

Defined results: null message lists, null messages and null contents count as no message; a record with several
assistant messages has the defects of all of them, once each; repeated rows are judged each; messages are read
in full.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill import workspace

DEFECTS = ("empty", "copied", "refusal", "language", "truncated")

# How an answer is declined.  English, German, French, Spanish, Portuguese, Italian, Dutch, Danish,
# Norwegian, Swedish, Polish, Czech, Turkish, Russian, Ukrainian, Arabic, Chinese, Japanese and Korean.
NOT_ABLE = (
    r"(?:can(?:\s?not|['’]?t)|am\s+(?:not\s+able|unable|not\s+permitted|not\s+allowed)\s+to|['’]m\s+(?:not\s+able|unable|not\s+permitted|"
    r"not\s+allowed|afraid\s+I\s+can(?:\s?not|['’]t))(?:\s+to)?|(?:won['’]?t|will\s+not)(?:\s+be\s+able\s+to)?|"
    r"(?:do\s+not|don['’]t)\s+have\s+the\s+(?:ability|option)\s+to|(?:must|have\s+to|need\s+to)\s+(?:decline|refuse)|"
    r"(?:['’]d|would)\s+(?:prefer|rather)\s+not)"
)
TASK = (
    r"(?:help|assist|fulfil|comply|provide|review|comment|evaluat|judg|assess|giv|say\s+anything|discuss|answer|respond|complete|continue|"
    r"offer|share|opin|engage|look\s+at|(?:do|perform|carry\s+out|write)\s+(?:that|this|it|so|an?\b|the|any|code|such))"
)
REFUSALS = [
    rf"\bI\s*{NOT_ABLE}\b(?:\s+(?:to|with|you|in|on|be|able|possibly|currently|really|it))*\s*,?\s*{TASK}",
    r"\bI\s*(?:must|have\s+to|need\s+to|will\s+have\s+to)\s+(?:respectfully\s+|politely\s+)?(?:decline|refuse)\b",
    r"\b(?:is|would\s+be)\s+(?:not\s+possible|impossible|inappropriate|not\s+appropriate)\s+for\s+me\s+to\b",
    r"\b(?:is|are|goes|go|lies|falls)\s+(?:beyond|outside|against)\s+(?:of\s+)?(?:my|what\s+I)\b",
    r"\bis\s+something\s+I\s+(?:can\s?not|can['’]?t|won['’]?t|will\s+not|am\s+not\s+able\s+to)\s+do\b",
    r"\bmy\s+(?:policies|policy|guidelines|rules|instructions|programming)\s+(?:do|does)\s+not\s+allow\b",
    r"\bI\s+(?:decline|refuse)\s+to\b",
    r"\b(?:kann|darf|möchte|werde)\s+(?:ich\s+)?(?:\w+\s+){0,5}(?:nicht|keine\w*)\s+(?:\w+\s+){0,4}(?:helfen|behilflich|bewerten|beurteilen|kommentieren|beantworten|geben|erfüllen|prüfen)",
    r"\bje\s+ne\s+(?:peux|puis|pourrai|dois|souhaite|saurais)\s+(?:\w+\s+){0,2}(?:vous\s+)?(?:aider|commenter|évaluer|répondre|examiner|donner|traiter|juger|fournir)",
    r"\bje\s+ne\s+suis\s+pas\s+(?:en\s+mesure|autorisée?|capable|habilitée?)\b|\bje\s+(?:dois|préfère)\s+(?:refuser|décliner)\b",
    r"\b(?:no|não)\s+(?:puedo|posso|podré|poderei)\s+(?:\w+\s+){0,3}(?:ayudar|comentar|evaluar|revisar|responder|ajudar|avaliar|analisar|opinar|dar|cumplir|cumprir|atender|fornecer|proporcionar)",
    r"\bnon\s+posso\s+(?:\w+\s+){0,2}(?:aiutar|comment|valutar|risponder|fornir)",
    r"\bik\s+kan\s+(?:\w+\s+){0,4}niet\s+(?:\w+\s+)?(?:helpen|beoordelen|beantwoorden|reageren)",
    r"\b(?:kan|kunne)\s+(?:jeg|jag\s+)?(?:\w+\s+){0,2}(?:ikke|inte)\s+(?:\w+\s+){0,2}(?:hjelpe|hjælpe|hjälpa|vurdere|kommentere|kommentera|granska|bedöma|gi\b|give\b|ge\b|svare|svara|gjennomgå|gennemgå)",
    r"\bnie\s+mogę\s+(?:\w+\s+){0,2}(?:pomóc|ocenić|skomentować|odpowiedzieć)|\bnemohu\s+(?:\w+\s+){0,2}(?:pomoci|posoudit|komentovat|hodnotit|odpovědět)",
    r"\byardımcı\s+ola(?:mam|mıyorum|mayacağım|maz)|\b(?:yorum\s+yapa|inceleye|değerlendire|cevap\s+vere|yanıt\s+vere)(?:mem|miyorum|meyeceğim|mam|mıyorum)",
    r"(?:я\s+)?не\s+(?:могу|смогу|имею\s+возможности)\s+(?:\w+\s+){0,4}(?:помочь|оцен|коммент|ответ|выполн|рассм|обсужд|дать|провер)|вынужден\w*\s+отказать",
    r"\bне\s+можу\s+(?:\w+\s+){0,3}(?:допомог|оцін|комент|відпов|перевір)|(?:لا\s+(?:أستطيع|يمكنني)|لن\s+أتمكن)",
    r"(?:我|抱歉|对不起).{0,12}(?:无法|不能|没有办法)(?:.{0,12})(?:帮|评|提供|回答|协助|完成|满足|审查)",
    r"(?:申し訳|すみません|恐れ入り).{0,30}(?:できません|できかねます|いたしかねます|お答え)|(?:レビュー|コメント|評価|回答|お手伝い).{0,8}(?:できません|できかねます|いたしかねます)",
    r"(?:도와|답변|검토|평가).{0,12}(?:수\s*없|드릴\s*수\s*없)",
]
REFUSAL = re.compile("|".join(REFUSALS), re.I)
#: One of these stands in every text that REFUSAL matches; a plain search, in lower case and with ' for ’.
HINTS = re.compile(
    r"\bi ?(?:can|am|won|will|do|must|have|need|would|decline|refuse)|\bi'(?:m|d)\b|for me to|(?:beyond|outside|against) (?:of )?(?:my|what)|my (?:polic|guide|rule|instr|progr)|"
    r"nicht|keine|je ne|je dois|je préf|n[oã]o? p|non p|niet|ikke|inte|nie m|nemohu|yardımcı|yorum|incel|değer|cevap|yanıt|[^\x00-\u024f]"
)
#: What the other clauses of a refusal talk about: the talk itself, not the code.
ASIDE = re.compile(
    r"\b(?:sorry|apolog\w*|(?:un)?fortunately|regret\w*|thank\w*|please\s+(?:consult|ask|provide|contact|reach|try|refer|send|share|feel|seek|turn|let|note|understand|submit|rephrase)|"
    r"polic(?:y|ies)|guidelines?|language\s+models?|AI|assistants?|maintainers?|reviewers?|reviews?|reviewing|engineers?|someone\s+else|colleagues?|experts?|humans?|requests?|"
    r"questions?|anything\s+else|something\s+else|happy\s+to|glad\s+to|feel\s+free|let\s+me\s+know|consult\w*|reach\s+out|asking|help\w*|assist\w*|i\s+(?:fully\s+|do\s+)?understand|"
    r"i\s+hope|capabilit\w*|abilit(?:y|ies)|permitted|opinions?|judg(?:e?ments?|ing)|assessments?|evaluations?|feedback|hello|hi|instructions?|"
    r"qualified|responsib\w*|professional\w*|authori[sz]ed|have\s+to\s+say|"
    r"leid|leider|bitte|danke\w*|modell|aufgabe|richtlinien|anfrage|fragen?|désolée?|malheureusement|merci|modèle|demande|question|"
    r"siento|lamento|gracias|modelo|solicitud|ajuda|ayuda|desculpe|sinto|infelizmente|obrigad[oa]|pedido|mi\s+dispiace|purtroppo|grazie|modello|richiesta|"
    r"spijt|helaas|bedankt|beklager|dessverre|desværre|tyvärr|ledsen|takk?|tack|przykro|niestety|przepraszam|bohužel|omlouvám|üzgünüm|maalesef|özür|"
    r"сожалению|извините|простите|спасибо|модель|жаль|вибачте|شكرا|عذرا|آسف)\b|抱歉|对不起|谢谢|语言模型|人工智能|申し訳|すみません|ありがとう|言語モデル|죄송|감사|언어\s*모델",
    re.I,
)
# A clause ends at these marks and before these words; behind a comma only if a verb follows.
CLAUSES = re.compile(
    r"(?<=[.!?;:])\s+|[。！？；\n]+|,?\s+(?=(?:but|however|though|although|yet|aber|jedoch|mais|pero|mas|però|maar|men|ale|но|але)\s)|(?:但是?|でも)|"
    r",\s+(?=[^,.;!?]*\b(?:is|are|was|were|has|have|had|do|does|should|could|would|can|may|must|will|needs?|looks?|seems?|fails?|breaks?|works?|leaks?|holds?|ist|sind|hat|est|sont|es|son|é|são)\b)"
)
#: Tokens of a lead-in such as "Here is the change:" that make no review of a copied diff.
LEAD_IN = 8
# Frequent function words that tell languages of one script apart.
FUNCTION_WORDS = {
    "en": "the of and to is that it this for with as be are not on by from or an was which we here does would could should can if at in but has have each only one there what how why when still every because before".split(),
    "de": "der die das und ist nicht den dem ein eine einen zu mit für auf auch wird wenn aber oder wie sich des noch sonst weil dass werden dieser diese dafür darauf müssen hier nach von beim kann sollte".split(),
    "fr": "le la les et est un une des du dans pas que qui pour sur ce cette avec ne plus mais par au aux il elle sont être alors parce même cela son sa devrait dès sinon ici".split(),
    "es": "el la los las y es un una de del en que no por para con se lo su al más pero este esta ese como debería ser porque aunque además todavía aquí cuando falta sería".split(),
    "pt": "o a os as e é um uma de do da dos das em no na que não por para com se ao mais mas este esta isso como deveria ser porque embora ainda aqui quando falta seria são dele além".split(),
    "it": "il lo la gli le e è un una di del della in che non per con si al più ma questo questa come essere perché anche ancora qui quando dovrebbe sono nel".split(),
    "nl": "de het een en is niet van op te dat die voor met als zijn maar ook aan er om bij dan nog wordt deze dit omdat hier".split(),
    "pl": "i w nie na się z do to jest że o jak ale po co tak za od przez dla są czy tego który ponieważ tutaj jeszcze".split(),
}
LANGUAGE_OF: dict[str, list[str]] = {}
for _name, _words in FUNCTION_WORDS.items():
    for _word in _words:
        LANGUAGE_OF.setdefault(_word, []).append(_name)
SCRIPTS = (
    ("cyrillic", re.compile("[Ѐ-ӿ]")),
    ("kana", re.compile("[぀-ヿ]")),
    ("han", re.compile("[一-鿿]")),
    ("hangul", re.compile("[가-힯]")),
    ("arabic", re.compile("[؀-ۿ]")),
    ("hebrew", re.compile("[֐-׿]")),
    ("greek", re.compile("[Ͱ-Ͽ]")),
    ("devanagari", re.compile("[ऀ-ॿ]")),
    ("latin", re.compile("[A-Za-zÀ-ɏ]")),
)
CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`|https?://\S+", re.S)
QUOTED = re.compile(r"\"[^\"\n]{1,80}\"|“[^”\n]{1,80}”|«[^»\n]{1,80}»")
IDENTIFIER = re.compile(r"\w*(?:_|::|[a-z][A-Z]|\w[./]\w)[\w./:]*(?:\(\))?|\w+\(\)")
WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"[^\W_]+")
INVISIBLE = re.compile("[\\s ­͏ᅟᅠ᠎​-‏ -  -⁤⠀　ㅤ︀-️﻿]")


MARKUP = re.compile(r"[<&\[]")
COMMENTS = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
HIDDEN = re.compile(
    r"\[[^\]]*\]:\s*#\s*\(.*?\)|&(?:nbsp|ensp|emsp|thinsp|zwnj|zwj|shy|#160|#xa0|#8203|#x200b);|</?[a-z][a-z0-9]*(?:\s[^<>]*)?/?>|```[a-z]*", re.I
)
BARE_MARKS = re.compile(r"[*_~`>#\-=.…|:;,()\[\]{}!\\/+\"']*")


def visible(text: str | None) -> bool:
    """Whether anything is left once markup without content, entities for space, comments and punctuation are gone."""
    if text is None:
        return False
    if not MARKUP.search(text) and "```" not in text and WORD.search(text):
        return True
    return not BARE_MARKS.fullmatch(INVISIBLE.sub("", HIDDEN.sub("", COMMENTS.sub("", text))))


def tokens(text: str) -> list[str]:
    """The words of a text, in folded case, without the name of a diff's fence."""
    return TOKEN.findall(text.replace("```diff", " ").casefold())


def copied(answer: str, prompt: str | None) -> bool:
    """The answer's tokens are half of the diff at least, and all but a tenth or a lead-in are the prompt's.

    With counts; so quoting some lines and a remark is no copy.  A lead-in is no longer than what is copied.
    """
    if not prompt:
        return False
    mine, parts = tokens(answer), prompt.split("```", 2)
    diff = TOKEN.findall(parts[1].split("\n", 1)[-1] if len(parts) > 1 else prompt)
    if not diff or 2 * len(mine) < len(diff):
        return False
    own = Counter(mine)
    if 2 * sum((own & Counter(x.casefold() for x in diff)).values()) < len(diff):
        return False
    shared = sum((own & Counter(tokens(prompt))).values())
    return len(mine) - shared <= max(0.1 * len(mine), min(LEAD_IN, shared))


def prose(text: str) -> str:
    """The text without code, links, quoted strings and identifiers."""
    return IDENTIFIER.sub(" ", QUOTED.sub(" ", CODE.sub(" ", text)))


ENGLISH = {w for w in FUNCTION_WORDS["en"] if LANGUAGE_OF[w] == ["en"]}
OTHERS = {w for w, names in LANGUAGE_OF.items() if names != ["en"]}


@lru_cache(maxsize=10_000)
def language(text: str) -> str | None:
    """Script, and within Latin the language, of the prose; null where too little is left to tell."""
    if text.isascii():
        # words that stand alone, without code in them, already say that most texts are English
        alone = [w.strip(".,;:!?()") for w in text.lower().split()]
        english = sum(w in ENGLISH for w in alone)
        if english >= 3 and english >= 2 * sum(w in OTHERS for w in alone):
            return "en"
    said = prose(text)
    if said.isascii():
        letters = {name: 0 for name, _ in SCRIPTS} | {"latin": sum(map(len, WORD.findall(said)))}
    else:
        letters = {name: len(shape.findall(said)) for name, shape in SCRIPTS}
    total = sum(letters.values())
    if total < 4:
        return None
    if letters["kana"] >= 0.1 * total:
        return "ja"
    top = max(letters, key=lambda s: letters[s])
    if top == "latin":
        others = total - letters["latin"]
        if others >= 0.3 * total:
            top = max((s for s in letters if s != "latin"), key=lambda s: letters[s])
        else:
            votes: Counter = Counter()
            for w in WORD.findall(said.casefold()):
                for name in LANGUAGE_OF.get(w, ()):
                    votes[name] += 1 / len(LANGUAGE_OF[w])
            ranked = votes.most_common(2)
            if not ranked or ranked[0][1] < 2:
                return None
            if len(ranked) > 1 and "en" in (ranked[0][0], ranked[1][0]) and ranked[0][1] < 1.5 * ranked[1][1]:
                return None  # kin languages are no matter, but English or not must be clear
            return ranked[0][0]
    return {"han": "zh", "cyrillic": "ru", "hangul": "ko"}.get(top, top)


def asked_in(prompt: str | None, system: str | None) -> str:
    """The language of a prompt outside its code, else of the system message, else English."""
    outside = " ".join(prompt.split("```")[::2]) if prompt else ""
    return language(outside) or language(system or "") or "en"


def refuses(answer: str) -> bool:
    """Whether a clause declines to answer and no other says anything on the code, whatever their number.

    Fenced code and quoted lines are no clauses; inline code outside the declining clauses is a remark.
    """
    if not HINTS.search(answer.lower().replace("’", "'")) or not REFUSAL.search(answer):
        return False
    said = re.sub(r"```.*?(?:```|\Z)|^\s*>.*$", " ", answer, flags=re.S | re.M) if "```" in answer or ">" in answer else answer
    declined = False
    for clause in CLAUSES.split(said):
        if REFUSAL.search(clause):
            declined = True
        elif WORD.search(clause) and ("`" in clause or IDENTIFIER.search(clause) or not ASIDE.search(clause)):
            return False
    return declined


# -- abrupt endings ------------------------------------------------------------------------

# Words behind which an English sentence goes on.
DETERMINERS = set("the a an this that these those each every any our its their another no some both which whose your my one".split())
OPEN_WORDS = DETERMINERS | set(
    "of to in on at by for from with without into onto and or but because since unless while when where if as than whether so though "
    "although until is are was were be been has have had does do did can could should would will may might must not we they you it's "
    "he she who what how why there only just also very between through across about over under after before during per via rather instead".split()
)
#: Whole words that may end a sentence: those of the list above, and pronouns and adverbs, which are no cut-off heads of longer words.
CLOSERS = set("before after through over under about so in on there not this it one both only instead rather though".split()) | set(
    "me us them him her mine ours yours theirs too also again now then here already anyway yet ever well else off out up down away back".split()
)
FINAL = re.compile(r"[.!?。！？…]['\")\]*_~`»”’）」]*$")
LAST = re.compile(r"([^\W\d_]+)\W*$")


HUMP = re.compile(r".*[a-z0-9](?=[A-Z])")
WHOLE_COMMENTS = re.compile(r"<!--.*?-->", re.S)
FENCED = re.compile(r"```.*?```", re.S)
UNCOUNTED = re.compile(r"`[^`\n]*`|(?m:^\s*>.*$)|[:;]-?[()]|(?m:^\s*\w{1,2}\))")
LIST_ITEM = re.compile(r"(?:\d+[.)]|[-*+•]|#+)")
GOES_ON = re.compile(r"[,(\[{=+&|<:;]$|\s[-–—]$")
CLOSED = re.compile(r"https?://\S+$|[`'\")\]}*_~%]$|[0-9]$")
WORDS = re.compile(r"[^\W_]+(?:_[^\W_]+)*|`[^`]*`")


@lru_cache(maxsize=100_000)
def pieces(word: str) -> str:
    """The last part of an identifier or word, in lower case."""
    return HUMP.sub("", word.rsplit("_", 1)[-1]).lower()


def ending(answer: str) -> tuple[str, str | None, str | None]:
    """('open' | 'closed' | 'ask', word before last, last word) of an answer's end."""
    text = answer
    if "<!--" in text:
        text = WHOLE_COMMENTS.sub("", text)
        if "<!--" in text:
            return "open", None, None
    if text.count("```") % 2:
        return "open", None, None
    outside = FENCED.sub(" ", text) if "```" in text else text
    if outside.count("`") % 2:
        return "open", None, None
    if "(" in outside or "[" in outside:
        flat = UNCOUNTED.sub(" x ", outside)
        if flat.count("(") > flat.count(")") or flat.count("[") > flat.count("]"):
            return "open", None, None
    tail = text.rstrip()
    line = tail.rsplit("\n", 1)[-1].strip()
    if LIST_ITEM.fullmatch(line) and "\n" in tail:
        return "open", None, None  # a list item without text
    final = FINAL.search(tail[-40:])
    if line.startswith(">") and not final:
        return "closed", None, None  # the end is a quoted line
    if tail.endswith("```") or final:
        return "closed", None, None
    if GOES_ON.search(tail[-40:]):
        return "open", None, None
    if CLOSED.search(line):
        return "closed", None, None
    m = LAST.search(tail)
    if not m or m.end(1) != len(tail):
        return "closed", None, None  # emoji, symbols
    words = WORDS.findall(tail)
    last = words[-1] if words else ""
    before = words[-2].lower() if len(words) > 1 else None
    return "ask", before, pieces(last)


#: Uses, at the corpus's share of sentence ends, that are added to a word's own; so a few uses prove little.
PRIOR, PRIOR_MODIFIER = 2, 10
#: An ending is abrupt if the word's share of sentence ends is under this part of the corpus's share,
SELDOM = 0.1
#: ... or, behind a determiner, that behind determiners is,
SELDOM_MODIFIER = 0.1
#: ... or, for a word rarer than the longer words that begin with it, if it is under this part, while
SELDOM_HEAD = 0.75
#: one in so many uses of the longer words counts as a use that ended no sentence.
COMPLETIONS = 200
#: Short replies are answers (as the problem is stated): one sentence of at most so many words needs no full form, and
#: only an open delimiter or a word that leaves a sentence open tells that it breaks off.
REPLY_WORDS = 5
SENTENCE_END = re.compile(r"[.!?]\s|\n")
MARKS = re.compile(r"[^\W_]+(?:_[^\W_]+)*|`[^`]*`|[.!?;:,)\n]+")


MARK = frozenset(".!?;:,)\n")
END = frozenset(".!?\n")


def count_endings(answer: str, counts: dict[str, list[int]]) -> None:
    """Add each word of the prose to ``counts``: uses, sentence ends, uses and ends behind a determiner."""
    found = MARKS.findall(FENCE.sub(" ", answer) if "```" in answer else answer)
    before = False
    for word, after in zip(found, found[1:], strict=False):
        first = word[0]
        if first in MARK:
            before = False
            continue
        row = counts.get(key := pieces(word) if first != "`" else "`")
        if row is None:
            row = counts[key] = [0, 0, 0, 0]
        ends = after[0] in END
        row[0] += 1
        row[1] += ends
        if before:
            row[2] += 1
            row[3] += ends
        before = word.lower() in DETERMINERS


FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)


def judge(prompt: str | None, answer: str | None, system: str | None) -> tuple[list[str], str | None, str | None]:
    """(defects, word before the last, last word); the words only if the corpus must say how the text ends."""
    if not visible(answer):
        return ["empty"], None, None
    found = []
    if copied(answer, prompt):
        found.append("copied")
    if refuses(answer):
        found.append("refusal")
    spoken = language(answer)
    if spoken and spoken != asked_in(prompt, system):
        found.append("language")
    state, before, last = ending(answer)
    if before == "of" and last in ("these", "those", "this", "that"):
        state, last = "closed", None  # "... is one of these"
    if state == "open":
        found.append("truncated")
    elif state == "ask" and (len(answer.split()) > REPLY_WORDS or SENTENCE_END.search(answer.strip()) or last in OPEN_WORDS - CLOSERS):
        return found, before, last
    return found, None, None


def turns_of(roles: list[str | None], contents: list[str | None]) -> list[tuple[str | None, str | None, str | None]]:
    """(user message, answer, system message) of every assistant message with a content; one without an answer if there is none."""
    given = [(r, c) for r, c in zip(roles, contents, strict=True) if c is not None]
    system = next((c for r, c in given if r == "system"), None)
    user = next((c for r, c in given if r == "user"), None)
    out: list[tuple[str | None, str | None, str | None]] = []
    for role, content in given:
        if role == "user":
            user = content
        elif role == "assistant":
            out.append((user, content, system))
    return out or [(user, None, system)]


PASSED = "row bigint, record_id bigint, defects array<string>, before string, last string, word string, n bigint, ends bigint, after_det bigint, det_ends bigint"
KINDS = (pa.int64(), pa.int64(), pa.list_(pa.string()), *[pa.string()] * 3, *[pa.int64()] * 4)
#: Words that a task counts before it passes the counts on.
COUNTED = 200_000


def _passed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], names=[f.split()[0] for f in PASSED.split(", ")])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three kinds of rows: a record with its defects, the last words of one of its answers, a word with its counts.

    Records without a defect whose answers all end well give none of the first two.
    """
    context = TaskContext.get()
    row = (context.partitionId() if context else 0) << 33
    counts: dict[str, list[int]] = {}
    seen: set[str] = set()
    for batch in batches:
        rows: list[tuple] = []
        messages = batch.column("messages")
        flat = messages.flatten()
        roles, contents = (flat.field(k).to_pylist() for k in (0, 1)) if len(flat) else ([], [])
        if flat.null_count:
            gone = flat.is_null().to_pylist()
            contents = [None if g else c for g, c in zip(gone, contents, strict=True)]
        at = 0
        for ident, size in zip(batch.column("record_id").to_pylist(), messages.value_lengths().to_pylist(), strict=True):
            row += 1
            size = size or 0
            defects: list[str] = []
            asked = 0
            for prompt, answer, system in turns_of(roles[at : at + size], contents[at : at + size]):
                found, before, last = judge(prompt, answer, system)
                defects += found
                if last is not None:
                    asked += 1
                    rows.append((row, None, None, before, last, None, 0, 0, 0, 0))
                if answer:
                    count_endings(answer, counts)
                fresh = set(TOKEN.findall(prompt or "")) - seen
                seen |= fresh
                for word in fresh:  # that it is used at all, wherever
                    counts.setdefault(pieces(word), [0, 0, 0, 0])
            at += size
            if defects or asked:
                rows.append((row, ident, sorted(set(defects), key=DEFECTS.index), None, None, None, 0, 0, 0, 0))
        yield _passed(rows)
        if max(len(counts), len(seen)) > COUNTED:
            yield _passed([(None, None, None, None, None, w, *c) for w, c in counts.items()])
            counts.clear()
            seen.clear()
    yield _passed([(None, None, None, None, None, w, *c) for w, c in counts.items()])


def flag_pairs(records: DataFrame) -> DataFrame:
    """(record_id, defects): every triggered defect of each defective record, in the rules' order."""
    passed = workspace.keep(records.select("record_id", "messages").mapInArrow(_judged, PASSED), "judged")
    judged = passed.where("defects is not null").select("row", "record_id", "defects")
    ends = passed.where("last is not null").select("row", "before", "last")
    sums = [F.sum(c).alias(c) for c in ("n", "ends", "after_det", "det_ends")]
    words = workspace.keep(passed.where("word is not null").groupBy("word").agg(*sums), "words")

    asked = ends.select("last").distinct()
    known = asked.join(words, asked["last"] == words["word"], "left")
    heads = words.select(F.explode(F.expr("transform(sequence(1, greatest(1, length(word) - 1)), k -> left(word, k))")).alias("last"), "word", "n")
    heads = heads.where("length(last) > 0 and last <> word").join(asked, "last", "left_semi").groupBy("last").agg(F.sum("n").alias("longer"))
    base = words.agg(F.try_divide(F.sum("ends"), F.sum("n")).alias("base"), F.try_divide(F.sum("det_ends"), F.sum("after_det")).alias("det_base"))
    facts = known.join(heads, "last", "left").crossJoin(F.broadcast(base))
    uses, longer = F.col("n") + PRIOR, F.coalesce("longer", F.lit(0))
    share = lambda more: (F.col("ends") + PRIOR * F.col("base")) / (uses + more)
    often = share(F.lit(0)) < SELDOM * F.col("base")
    unseen = F.col("word").isNull() & F.col("longer").isNotNull()
    cut = unseen | ((F.col("n") < longer) & (share(longer / COMPLETIONS) < SELDOM_HEAD * F.col("base")))
    det_share = (F.col("det_ends") + PRIOR_MODIFIER * F.col("det_base")) / (F.col("after_det") + PRIOR_MODIFIER)
    modifier = det_share < SELDOM_MODIFIER * F.col("det_base")
    open_word = F.col("last").isin(sorted(OPEN_WORDS - CLOSERS))
    whole = F.col("last").isin(sorted(CLOSERS))
    facts = facts.select(
        "last",
        (open_word | (F.coalesce(cut, F.lit(False)) & ~whole) | F.coalesce(often, F.lit(False))).alias("never"),
        F.coalesce(modifier, F.lit(False)).alias("modifier"),
    )
    behind = F.col("before").isin(sorted(DETERMINERS))
    abrupt = F.coalesce(F.col("never") | (F.col("modifier") & F.coalesce(behind, F.lit(False))), F.lit(False))
    cut_off = ends.join(facts, "last").where(abrupt).select("row", F.lit(True).alias("cut_off")).distinct()
    told = judged.join(cut_off, "row", "left")
    full = F.when(F.col("cut_off"), F.array_union("defects", F.array(F.lit("truncated")))).otherwise(F.col("defects"))
    return told.select("record_id", full.alias("defects")).where(F.size("defects") > 0)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, defect): the first defect of each defective chat record."""
    flagged = flag_pairs(workspace.load(spark, sf_dir, "chat_records"))
    return flagged.select("record_id", F.element_at("defects", 1).alias("defect"))


def p3_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, defect): every triggered defect, one row each."""
    flagged = flag_pairs(workspace.load(spark, sf_dir, "chat_records"))
    return flagged.select("record_id", F.explode("defects").alias("defect"))
