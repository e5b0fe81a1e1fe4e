"""Pieces of the SQL counterparts."""

from __future__ import annotations

# Unicode whitespace spelled out: the SQL engine's \s covers ASCII only.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def replace_all(c: str, pattern: str, by: str) -> str:
    return f"regexp_replace({c}, '{pattern}', '{by}', 'g')"


def collapse(c: str) -> str:
    return f"trim({replace_all(c, WS + '+', ' ')})"


def punct(c: str) -> str:
    s = replace_all(c, "[:;|/]", ",")
    s = replace_all(s, f",{WS}*,+", ",")
    s = replace_all(s, f"{WS}*,{WS}*", ", ")
    return f"nullif({collapse(s)}, '')"


def amt(c: str) -> str:
    """Protect commas next to a digit, drop the others, put the protected ones back."""
    s = replace_all(c, r"(\p{Nd}),", r"\1" + "\x01")
    s = replace_all(s, r",(\p{Nd})", "\x01" + r"\1")
    return collapse(f"replace(replace({s}, ',', ' '), '\x01', ',')")


def canon(c: str) -> str:
    s = f"lower({collapse(f'coalesce({c}, chr(32))')})"
    s = f"CASE WHEN {s} IN ('', 'none', 'nan', '<na>') THEN '' ELSE {s} END"
    s = replace_all(s, "[,.;:]", "")
    s = replace_all(s, r"\bfilm coated\b", "film-coated")
    s = replace_all(s, r"\btablets\b", "tablet")
    s = replace_all(s, r"\bcapsules\b", "capsule")
    return collapse(s)


def piped(*parts: str) -> str:
    return " || ' | ' || ".join(f"coalesce({p}, '')" for p in parts)


def shown(*parts: str) -> str:
    return "concat_ws(' · ', " + ", ".join(f"nullif(trim({p}), '')" for p in parts) + ")"


def hashed(*parts: str) -> str:
    sized = ", ".join(
        f"CAST(length(coalesce(CAST({p} AS VARCHAR), '')) AS VARCHAR), coalesce(CAST({p} AS VARCHAR), '')" for p in parts
    )
    return f"sha256(concat_ws(':', {sized}))"


def money(c: str) -> str:
    return f"format('${{:,.2f}}', {c})"


def cents(c: str) -> str:
    return f"CAST(round(CAST({c} AS DECIMAL(38,6)), 2) AS DECIMAL(18,2))"
