"""DuckDB SQL of the string functions, for the queries' equivalents."""

from __future__ import annotations

from hunkmill.functions import text

WS = text.WS


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_start(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+', '')"


def trim_end(e: str) -> str:
    return rf"regexp_replace({e}, '{WS}+\z', '')"


def trim(e: str) -> str:
    return trim_start(trim_end(e))


def strip_comments(e: str) -> str:
    return rf"regexp_replace({e}, '(?s)<!--(?:>|->|.*?(?:-->|\z))', '', 'g')"


def clean_body(e: str) -> str:
    lines = f"list_transform(string_split({strip_comments(e)}, chr(10)), lambda l: {trim_end('l')})"
    own = f"list_filter({lines}, lambda l: not starts_with({trim_start('l')}, '>'))"
    return trim(rf"regexp_replace(array_to_string({own}, chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g')")


def hits(e: str, pattern: str) -> str:
    return f"len(regexp_extract_all({e}, {quoted(pattern)}))"


def design_score(e: str, replies: str) -> str:
    design, nit = (f"{hits(e, p)}::float" for p in (text.DESIGN, text.NIT))
    return (
        f"greatest(least((least({design} * 0.25::float, 0.6::float) + least({replies}::float * 0.12::float, 0.36::float)"
        f" + least(strlen({e})::float / 600.0::float, 0.2::float)"
        rf" + case when regexp_matches({e}, '{text.QUESTION}') then 0.1::float else 0::float end - {nit} * 0.3::float)::float, 1::float), 0::float)"
    )


def category(e: str, replies: str) -> str:
    design, nit = (hits(e, p) for p in (text.DESIGN, text.NIT))
    return (
        f"case when {nit} > {design} then 'nit' when {design} >= 1 or {replies} >= 2 then 'design'"
        rf" when regexp_matches({e}, '{text.QUESTION}') then 'question' else 'other' end"
    )


def is_trivial(e: str, min_len: int = 20) -> str:
    return f"(strlen({e}) < {min_len} or regexp_matches({e}, {quoted(text.TRIVIAL)}))"


def is_bot(e: str) -> str:
    names = ", ".join(map(quoted, text.BOTS))
    return f"(ends_with(coalesce({e}, ''), '[bot]') or coalesce({e}, '') in ({names}))"


def repo_of(e: str) -> str:
    return f"coalesce(regexp_extract({e}, '/repos/([^/]*/[^/]*)', 1), '')"


def pr_number(e: str) -> str:
    last = f"list_last(string_split({e}, '/'))"
    return rf"(case when regexp_matches({last}, '^\+?[0-9]+$') then try_cast({last} as bigint) end)"


def user_prompt(repo: str, pr: str, path: str, hunk: str) -> str:
    return (
        f"('Repository: ' || {repo} || chr(10) || 'Pull request: #' || coalesce({pr}::varchar, '') || chr(10) || 'File: ' || {path}"
        f" || chr(10) || chr(10) || '```diff' || chr(10) || {trim_end(hunk)} || chr(10) || '```')"
    )


def fnv1a(*fields: str) -> str:
    def octets(e: str) -> str:
        digits = f"hex(encode({e}))"
        return f"list_transform(range(strlen({e})), lambda k: ('0x' || substr({digits}, 2 * k + 1, 2))::integer)"

    text_bytes = " || ".join(f"{octets(f)} || [255]" for f in fields)
    fold = (
        f"list_reduce(list_transform({text_bytes}, lambda b: b::uhugeint), lambda h, b: (xor(h, b) * 1099511628211::uhugeint)"
        " % 18446744073709551616::uhugeint, 14695981039346656037::uhugeint)"
    )
    return f"lower(lpad(to_hex({fold}::ubigint), 16, '0'))"
