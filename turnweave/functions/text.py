"""Column functions over dialogue text, ids and tags.  All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAUSE_MARKER = "[pause] User: [pause]"
_PAUSE = r"(?i)\[pause\]\s*User:\s*\[pause\]"
_EMOTION = r"(?iU)^\s*\(\s*emotion\s*:\s*([^)]+)\)\s*"


def strip(c: Column) -> Column:
    """Removes white space of any script from both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def keyed_draw(*key: Column) -> Column:
    """A number in [0, 2**32) that depends on the key alone, in place of a random draw."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(k.cast("string") for k in key))), 1, 8), 16, 10).cast("long")


def uniform(low: float, high: float, *key: Column) -> Column:
    return F.lit(low) + (F.lit(high) - F.lit(low)) * keyed_draw(*key) / F.lit(float(1 << 32))


# -- ids and names ---------------------------------------------------------------------


def topic_label(c: Column) -> Column:
    """What full-width parentheses enclose, else the trimmed topic; ``unknown`` if blank."""
    inner = none_if_empty(strip(F.regexp_extract(c, "（([^）]+)）", 1)))
    return F.coalesce(inner, none_if_empty(strip(c)), F.lit("unknown"))


def topic_slug(c: Column) -> Column:
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"[^A-Za-z0-9._-]+", "_")
    return F.coalesce(none_if_empty(F.regexp_replace(s, r"^[._-]+|[._-]+$", "")), F.lit("unknown"))


def canonical_scenario_id(c: Column) -> Column:
    """``[prefix_]scenario0*N`` and plain digits become ``scenarioN``; others stay."""
    s = strip(c)
    n = F.regexp_extract(s, r"^(?:(?:.+?)_)?scenario(\d+)$", 1)
    digits = F.regexp_extract(s, r"^(\d+)$", 1)
    number = F.coalesce(none_if_empty(n), none_if_empty(digits)).cast("decimal(38,0)").cast("string")
    return F.coalesce(F.concat(F.lit("scenario"), number), s)


def scenario_index(c: Column) -> Column:
    return none_if_empty(F.regexp_extract(strip(c), r"^scenario(\d+)$", 1)).cast("bigint")


def scenario_index_in_name(c: Column) -> Column:
    return none_if_empty(F.regexp_extract(c, r"(?:^|_)scenario(\d+)(?:\D|$)", 1)).cast("bigint")


def stem(topic: Column, index: Column, dialogue: Column, several: Column) -> Column:
    """``topic_scenarioN[_k]``; the suffix only if a scenario has several dialogues."""
    return F.concat_ws("_", topic, F.concat(F.lit("scenario"), index.cast("string")), F.when(several, dialogue.cast("string")))


_STEM = r"^(?:(.+)_)?(scenario(\d+))(?:_(\d+))?$"


def parse_stem(c: Column) -> dict[str, Column]:
    """``prefix, scenario_id, scenario_index, dialogue_index`` of a file stem."""
    part = lambda i: none_if_empty(F.regexp_extract(c, _STEM, i))
    n = part(3).cast("bigint")
    return {"prefix": part(1), "scenario_id": F.concat(F.lit("scenario"), n.cast("string")), "scenario_index": n, "dialogue_index": part(4).cast("bigint")}


def dialogue_id(topic: Column, mode: Column, index: Column, dialogue: Column) -> Column:
    return F.concat_ws("_", topic, mode, index.cast("string"), dialogue.cast("string"))


def conversation_id(c: Column) -> dict[str, Column]:
    """``topic, scenario_id, conversation_id`` of ``topic_mode_scenario[_k]``, read from the
    right, so that a topic may hold underscores."""
    m = r"^(.+)_(normal|[a-z]+)_(\d+)(?:_(\d+))?$"
    part = lambda i: none_if_empty(F.regexp_extract(c, m, i))
    scenario = F.concat(F.lit("scenario"), part(3).cast("bigint").cast("string"))
    return {"topic": part(1), "scenario_id": scenario, "dialogue_index": part(4).cast("bigint"), "conversation_id": F.concat_ws("_", part(1), part(2), scenario, part(4))}


def split_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")


def gender_norm(c: Column) -> Column:
    g = F.lower(strip(c))
    return (
        F.when(g.isNull() | (g == ""), F.lit(None).cast("string"))
        .when(g.startswith("male") | g.isin("m", "man", "masculine"), "male")
        .when(g.startswith("female") | g.isin("f", "woman", "feminine"), "female")
        .otherwise("other")
    )


# -- roles -----------------------------------------------------------------------------


def _role(c: Column) -> Column:
    return F.lower(strip(c))


def is_user(c: Column) -> Column:
    """Any user line, whatever its marker."""
    return _role(c).endswith("user")


def is_user_strict(c: Column) -> Column:
    """Users without a marker, overlapping and pausing ones; not their backchannels."""
    return _role(c).isin("user", "[overlap] user", "[pause] user")


def is_pause(c: Column) -> Column:
    return _role(c).startswith("[pause]")


def is_overlap(c: Column) -> Column:
    return _role(c).startswith("[overlap]")


def strip_role_prefix(c: Column) -> Column:
    return F.regexp_replace(c, r"(?iU)^(User|Agent):\s*", "")


# -- emotion tags ----------------------------------------------------------------------


def leading_emotion(c: Column) -> Column:
    return none_if_empty(F.lower(strip(F.regexp_extract(c, _EMOTION, 1))))


def strip_leading_emotion(c: Column) -> Column:
    return strip(F.regexp_replace(c, _EMOTION, ""))


def strip_emotion_tags(text: Column) -> Column:
    """Without the leading tag of each line; blank lines go."""

    def line(s: Column) -> Column:
        content = strip_leading_emotion(F.regexp_extract(s, r"(?s)^[^:]*:(.*)$", 1))
        role = strip(F.regexp_extract(s, r"(?s)^([^:]*):", 1))
        return F.when(~s.contains(":"), strip(s)).when(content == "", F.concat(role, F.lit(":"))).otherwise(F.concat(role, F.lit(": "), content))

    return F.array_join(F.transform(F.filter(F.split(text, r"\r\n|\n|\r"), lambda s: strip(s) != ""), line), "\n")


def normalize_emotion(text: Column, pool: list[str]) -> Column:
    """Tag variants rewritten to ``(emotion:x) rest`` where x is in the pool; else unchanged.

    In order: ``/x/``, ``(x)`` and ``emotion:x`` at the start, after any asterisks; then
    ``(x)``, ``[x]`` or ``/x/`` at the end.  The pool is case-sensitive; an empty one accepts
    any full form.
    """
    names = F.array(*map(F.lit, pool)) if pool else F.array().cast("array<string>")
    s = F.regexp_replace(strip(text), r"(?U)^\*+\s*", "")

    def known(inner: Column) -> Column:
        full = none_if_empty(F.regexp_extract(strip(inner), r"(?iU)^emotion\s*[:=]\s*([A-Za-z_\-]+)\s*$", 1))
        bare = strip(inner)
        ok = full.isNotNull() if not pool else F.array_contains(names, full)
        return F.when(ok, full).when(F.array_contains(names, bare), bare)

    def canonical(emotion: Column, rest: Column) -> Column:
        r = strip(rest)
        return F.when(emotion.isNotNull(), F.concat(F.lit("(emotion:"), emotion, F.lit(")"), F.when(r == "", F.lit("")).otherwise(F.concat(F.lit(" "), r))))

    slash = canonical(known(F.regexp_extract(s, r"^/([^/]+)/", 1)), F.regexp_extract(s, r"(?sU)^/[^/]+/\s*(.*)", 1))
    round_ = canonical(known(F.regexp_extract(s, r"^\(([^)]*)\)", 1)), F.regexp_replace(strip(F.regexp_extract(s, r"(?s)^\([^)]*\)(.*)", 1)), r"(?U)^\*+\s*", ""))
    word = none_if_empty(F.regexp_extract(s, r"(?iU)^emotion\s*[:=]\s*([A-Za-z_\-]+)", 1))
    plain = canonical(word if not pool else F.when(F.array_contains(names, word), word), F.regexp_extract(s, r"(?isU)^emotion\s*[:=]\s*[A-Za-z_\-]+\s*(.*)", 1))
    tail = r"(?sU)^(.*?)\s*[(\[/]([^)\]/]+)[)\]/]\s*$"
    last = canonical(known(F.regexp_extract(s, tail, 2)), F.regexp_extract(s, tail, 1))
    return F.coalesce(slash, round_, plain, last, text)


def sanitize_tts(c: Column) -> Column:
    """Spaced letters become one word (``A P P`` -> ``APP``, three or more); a bare or full
    tag at the end goes."""
    # the places found are marked, then the text is cut at their ends
    marked = F.regexp_replace(c, r"(?U)\b((?:[A-Za-z]\s+){2,}[A-Za-z])\b", "\ue000$1\ue001")
    parts = F.split(marked, "(?=\ue000)|(?<=\ue001)")
    found = lambda x: x.startswith("\ue000") & x.endswith("\ue001")
    plain = lambda x: F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"(?U)\s+", "")
    joined = F.array_join(F.transform(parts, lambda x: F.when(found(x), plain(x)).otherwise(x)), "")
    return strip(F.regexp_replace(joined, r"(?iU)\s*\(\s*(?:emotion\s*[:=]\s*)?[A-Za-z_\-]+\s*\)\s*$", ""))


# -- script lines ----------------------------------------------------------------------


def join_headers(text: Column) -> Column:
    """A line that is just ``[x]`` is joined with the next one."""
    return F.regexp_replace(text, r"(?mU)^(\[[^\]]+\])\s*\n\s*", "$1 ")


def split_pauses(lines: Column) -> Column:
    """Every pause marker on a line of its own; blank lines go."""
    marked = F.transform(
        F.filter(lines, lambda x: strip(x) != ""),
        lambda x: F.when(strip(x).rlike(_PAUSE), F.regexp_replace(strip(x), _PAUSE, "\n" + PAUSE_MARKER.replace("$", r"\$") + "\n")).otherwise(F.regexp_replace(x, r"(?U)\s+$", "")),
    )
    parts = F.flatten(F.transform(marked, lambda x: F.when(x.contains("\n"), F.transform(F.split(x, "\n"), strip)).otherwise(F.array(x))))
    return F.filter(parts, lambda x: x != "")


def merge_overlaps(lines: Column) -> Column:
    """``User:`` lines take up the ``[overlap] User:`` line right after them."""
    at = lambda i: F.element_at(lines, i + 1)  # noqa: E731  from 0
    n = F.size(lines)

    def one(x: Column, i: Column) -> Column:
        nxt = F.when(i + 1 < n, F.element_at(lines, F.least(i + 2, n)))
        prev = F.when(i > 0, F.element_at(lines, F.greatest(i, F.lit(1))))
        joins = x.startswith("User:") & F.coalesce(nxt.startswith("[overlap] User:"), F.lit(False))
        taken = x.startswith("[overlap] User:") & F.coalesce(prev.startswith("User:"), F.lit(False))
        rest = F.regexp_replace(F.substring(nxt, len("[overlap] User:") + 1, 1 << 30), r"(?U)^\s+", "")
        return F.when(taken, F.lit(None).cast("string")).when(joins, F.concat(F.regexp_replace(x, r"(?U)\s+$", ""), F.lit(" "), rest)).otherwise(x)

    return F.filter(F.transform(lines, one), lambda x: x.isNotNull())


def parse_line(c: Column) -> dict[str, Column]:
    """``role, content`` of a line, split at its first colon; null without one."""
    some = c.contains(":")
    return {"role": F.when(some, strip(F.regexp_extract(c, r"(?s)^([^:]*):", 1))), "content": F.when(some, strip(F.regexp_extract(c, r"(?s)^[^:]*:(.*)$", 1)))}


def score_of(c: Column) -> Column:
    return none_if_empty(F.regexp_extract(c, r"(?U)Score:\s*(\d+)", 1)).cast("bigint")


def fill_template(template: Column, emotions: Column) -> Column:
    return F.replace(template, F.lit("{EMOTION_LIST}"), F.array_join(emotions, "、"))


def reference_prompt(accent: Column, tags: Column, text: Column) -> Column:
    return F.concat(F.lit("["), accent, F.lit("]"), F.coalesce(tags, F.lit("")), F.lit(" "), text)


def progressive_texts(parts: Column) -> Column:
    """The first part, the first two, and so on, each joined by spaces."""
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), " "))


def strip_quotes(c: Column) -> Column:
    """Without white space and quotes around a key."""
    return F.regexp_replace(c, r"(?U)^[\s\"']+|[\s\"']+$", "")


def model_name_error(c: Column) -> Column:
    """Model names have a provider before a slash; null if it is there."""
    return F.when(~F.coalesce(c.contains("/"), F.lit(False)), F.concat(F.lit("no provider in model name: "), F.coalesce(c, F.lit(""))))


def as_list(c: Column) -> Column:
    """A value as a list: none for null or blank."""
    return F.when(c.isNull() | (strip(c) == ""), F.array().cast("array<string>")).otherwise(F.array(c))
