"""Table-driven classification and fact extraction from prose.

Behaviour is extended by adding rows to a spec list, not by adding functions:
each list compiles to plain Column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import MONEY, PARSED, parse_number, scaled


def first_label(c: Column, labels: Sequence[tuple[str, str]]) -> Column:
    """Field of the first listed fragment that occurs in `c`; null when none does."""
    out: Column | None = None
    for fragment, name in labels:
        hit = c.contains(fragment)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def prefix_label(c: Column, labels: Mapping[str, str]) -> Column:
    """Look up the leading characters of a label; all keys have one length."""
    (width,) = {len(k) for k in labels}
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.try_element_at(table, F.substring(c, 1, width))


@dataclass(frozen=True)
class FactSpec:
    """One figure to pull from prose.

    `signs` maps the text of `sign_group` to +1 or -1; other text leaves the
    sign alone. `unless` suppresses the figure when the matched phrase holds it.
    """

    name: str
    pattern: str
    value_group: int = 1
    factor: int = 1
    sign_group: int = 0
    signs: Mapping[str, int] = field(default_factory=dict)
    unless: str | None = None
    dtype: str = MONEY


def _value(phrase: Column, spec: FactSpec) -> Column:
    """The figure of a matched phrase; the phrase is short, so its groups are cheap to take."""
    v = parse_number(F.regexp_extract(phrase, spec.pattern, spec.value_group), PARSED)
    v = scaled(v, spec.factor, spec.dtype)
    if spec.sign_group:
        word = F.regexp_extract(phrase, spec.pattern, spec.sign_group)
        negative = [w for w, s in spec.signs.items() if s < 0]
        v = F.when(word.isin(*negative), -v).otherwise(v)
    if spec.unless:
        v = F.when(phrase.contains(spec.unless), None).otherwise(v)
    return v.cast(spec.dtype)


def phrase_of(name: str) -> Column:
    """The phrase `extract_facts` matched for a figure; empty when there was none."""
    return F.col(f"{name}_phrase")


def extract_facts(df: DataFrame, text: Column, specs: Sequence[FactSpec]) -> DataFrame:
    """Add one column per spec, null where the text does not state the figure.

    The text is searched once per spec; the matched phrase stays in
    `<name>_phrase`. Patterns must not look beyond their own match.
    """
    phrases = df.withColumns({f"{s.name}_phrase": F.regexp_extract(text, s.pattern, 0) for s in specs})
    return phrases.withColumns({s.name: _value(phrase_of(s.name), s) for s in specs})


def warnings_array(findings: Sequence[tuple[Column, str]]) -> Column:
    """ARRAY<STRING> of the messages whose condition holds."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(msg)) for cond, msg in findings]))
