"""The masks and missing-value rules once more, as DuckDB SQL text."""

from __future__ import annotations

from tablesync.functions.domains import FREE_DOMAINS
from tablesync.functions.text import NA_TOKENS


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def phone(x: str) -> str:
    digits = f"case when regexp_full_match({x}, '\\p{{N}}+') then {x} else regexp_replace({x}, '[^0-9]', '', 'g') end"
    head = f"left(regexp_replace({digits}, '^628', '08'), 4)"
    return f"case when coalesce({head}, '') = '' then '-' else {head} || 'xxxxxxxx' end"


def email(x: str) -> str:
    e = f"coalesce({x}, 'h@h')"
    name = f"split_part({e}, '@', 1)"
    domain = f"substr({e}, strpos({e}, '@') + 1)"
    return (
        f"case when length({name}) > 3 then left({name}, 3) || 'xxx' else 'xxxxxx' end || '@' || "
        f"case when strpos({e}, '@') = 0 then 'xxx.xxx' when {domain} = 'h' then '-' "
        f"when lower({domain}) not in ({quoted(FREE_DOMAINS)}) then 'privatedomain' else {domain} end"
    )


def general(x: str) -> str:
    t = f"coalesce({x}, '')"
    return f"case when length({t}) > 4 then 'xxxxxx' || right({t}, 4) when length({t}) < 1 then '-' else 'xxxxxxxxxx' end"


def flag(x: str) -> str:
    return f"cast(case when {x} is not null and cast({x} as varchar) <> '' then 1 else 0 end as bigint)"


def na(x: str) -> str:
    return f"case when {x} in ({quoted(NA_TOKENS)}) then null else {x} end"


def clamp(x: str) -> str:
    return (
        f"case when {x} > timestamp '2262-04-11 23:47:16.854775' or {x} < timestamp '1677-09-21 00:12:43.145225' "
        f"then timestamp '2262-04-11 23:47:16.854775' else {x} end"
    )


def time_or_null(x: str) -> str:
    t = f"try_cast({x} as timestamp)"
    return (
        f"case when {t} between timestamp '1677-09-21 00:12:43.145225' "
        f"and timestamp '2262-04-11 23:47:16.854775' then {t} end"
    )
