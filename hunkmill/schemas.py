"""Row types of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


PLAIN = {"bigint": T.LongType(), "int": T.IntegerType(), "float": T.FloatType(), "string": T.StringType(), "boolean": T.BooleanType()}


def _fields(text: str) -> list[str]:
    """Split at the commas outside angle brackets."""
    out, depth, last = [], 0, 0
    for k, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(text[last:k].strip())
            last = k + 1
    return [*out, text[last:].strip()]


def _type(text: str) -> T.DataType:
    text = text.strip()
    if text.startswith("array<"):
        return T.ArrayType(_type(text[6:-1]))
    if text.startswith("struct<"):
        pairs = [f.split(":", 1) for f in _fields(text[7:-1])]
        return T.StructType([T.StructField(n.strip(), _type(t)) for n, t in pairs])
    return PLAIN[text]


def _struct(text: str) -> T.StructType:
    """A schema from its text, without a session; data sources load this module in workers."""
    pairs = [f.split(" ", 1) for f in _fields(text)]
    return T.StructType([T.StructField(n, _type(t)) for n, t in pairs])


REVIEW_COMMENT = _struct(
    "id bigint, pull_request_url string, path string, diff_hunk string, body string, user struct<login: string>, created_at string, "
    "updated_at string, in_reply_to_id bigint, line bigint, original_line bigint"
)
CHAT_RECORD = _struct(
    "messages array<struct<role: string, content: string>>, meta struct<source_id: bigint, repo: string, pr: bigint, path: string, "
    "category: string, design_score: float, reply_count: int>"
)
FINDING = _struct(
    "finding_id string, session_id string, model_version string, created_at string, repo string, pr bigint, path string, hunk_header string, "
    "hunk_raw string, prompt string, critic_comment string, cited_line bigint, grounded boolean, "
    "human struct<verdict: string, is_design_problem: boolean, severity: string, note: string, judged_at: string, judged_by: string>, "
    "machine struct<verdict: string, reason: string, judged_at: string, judged_by: string>"
)
PR_META = _struct(
    "number bigint, title string, body string, user struct<login: string>, base struct<ref: string>, changed_files int, additions int, "
    "deletions int, html_url string"
)
ISSUE_COMMENT = _struct("body string, user struct<login: string>, created_at string")
PROMPT = _struct("system string, user string, path string, hunk_header string")
COMPLETION = _struct("choices array<struct<message: struct<role: string, content: string, reasoning_content: string>>>")
EXAMPLE = _struct("ids array<int>, prompt_len int")
