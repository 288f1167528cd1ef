"""Text, hashtag and briefing columns. Lengths are counted in characters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CARDS_PER_BRIEFING = 10
BLOCK = 5
BLANKS = " \t\n\x0b\f\r\u3000"

# Field labels, separators and default tags of the briefing format.
TOPIC = "选题"
LABELS = {
    "tags": "涉及地区/热点",
    "title": "标题",
    "subtitle": "副标题",
    "content": "内容",
    "angle": "思路",
    "date": "时间",
    "source": "来源",
}
DEFAULT_TAGS = ("#新闻", "#时政")
SOURCE_DASH = " – "

_HEADING = rf"(?m)^(?=[#* \t]*{TOPIC}[ \t\u3000]*\d+[:：* \t\u3000\r]*$)"
_NUMBER = rf"{TOPIC}[\s\u3000]*(\d+)"


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True if one of the words occurs. NULL text contains nothing."""
    hits = [F.coalesce(F.contains(text, F.lit(w)), F.lit(False)) for w in words]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def domain(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")


def snippet(text: Column, width: int) -> Column:
    return F.left(text, F.lit(width))


def clip(text: Column, width: int) -> Column:
    return F.substring(text, 1, width)


def utf8_size(text: Column) -> Column:
    return F.octet_length(text)


def prompt(template: Column, file_name: Column, content: Column) -> Column:
    """The template with its two placeholders filled, the file name first."""
    named = F.replace(template, F.lit("{source_filename}"), file_name)
    return F.replace(named, F.lit("{summary_content}"), content)


def last_topic_number(text: Column) -> Column:
    """Greatest topic number in a briefing, 0 if there is none."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(_NUMBER), F.lit(1)), lambda n: n.try_cast("int"))
    return F.coalesce(F.array_max(numbers), F.lit(0))


def missing_ranges(last: Column) -> Column:
    """Blocks of at most five topic numbers that follow ``last`` up to ten, as array of structs."""
    starts = F.sequence(F.least(last, F.lit(CARDS_PER_BRIEFING - 1)) + 1, F.lit(CARDS_PER_BRIEFING), F.lit(BLOCK))
    blocks = F.transform(starts, lambda s: F.struct(
        s.alias("first_no"), F.least(s + (BLOCK - 1), F.lit(CARDS_PER_BRIEFING)).alias("last_no")))
    return F.when(last < CARDS_PER_BRIEFING, blocks)


def topic_blocks(text: Column) -> Column:
    """One text per topic. Only a heading line starts a topic, a mention inside a body does not."""
    return F.filter(F.split(text, _HEADING), lambda b: b.rlike(rf"^[#* \t]*{TOPIC}[ \t\u3000]*\d+"))


def labelled_parts(block: Column) -> Column:
    """A topic text cut before each labelled line and each rule; the first part is heading and lead."""
    return F.split(block, rf"(?m)^(?=[*# \t]*(?:{'|'.join(LABELS.values())})[:：]|[ \t]*(?:-{{3,}}|\*{{3,}})[ \t\r]*$)")


def _filled(text: Column) -> Column:
    return F.when(text != "", text)


def _matches(pattern: str) -> Callable[[Column], Column]:
    return lambda text: text.rlike(pattern)


def card_texts(parts: Column) -> dict[str, Column]:
    """The text under each label, and the lead; the first part with a label counts."""
    texts = {"lead": _filled(F.trim(F.regexp_replace(F.get(parts, F.lit(0)), r"\A[^\n]*", ""), F.lit(BLANKS)))}
    for name, label in LABELS.items():
        mark = rf"\A[*# \t]*{label}[:：]"
        part = F.get(F.filter(parts, _matches(mark)), F.lit(0))
        texts[name] = _filled(F.trim(F.regexp_replace(part, rf"{mark}\**", ""), F.lit(BLANKS)))
    return texts


def _one_line(text: Column) -> Column:
    """The first line of a text, without the marks of bold print at its end."""
    return F.rtrim(F.substring_index(text, "\n", 1), F.lit(BLANKS + "*"))


def card_fields(texts: dict[str, Column]) -> dict[str, Column]:
    """The fields of one topic, in any of the three layouts that briefings use."""
    title, subtitle = _one_line(texts["title"]), _one_line(texts["subtitle"])
    halves = F.split(title, r"\s+/\s+", 2)
    joined = subtitle.isNull() & (F.size(halves) == 2)
    ymd = r"(\d{4})[-年](\d{1,2})[-月](\d{1,2})"
    numbers = [F.regexp_extract(texts["date"], ymd, i).try_cast("int") for i in (1, 2, 3)]
    source = _one_line(texts["source"])
    return {
        "card_no": F.regexp_extract(texts["block"], _NUMBER, 1).try_cast("int"),
        "tags": F.regexp_extract_all(F.coalesce(texts["tags"], F.lit("")), F.lit(r"(#[^#\s]+)"), F.lit(1)),
        "title": F.when(joined, F.get(halves, F.lit(0))).otherwise(title),
        "subtitle": F.when(joined, F.get(halves, F.lit(1))).otherwise(subtitle),
        "content": F.coalesce(texts["content"], texts["lead"]),
        "angle": texts["angle"],
        "date": F.try_make_timestamp(*numbers, *[F.lit(0)] * 3).cast("date"),
        "source": _filled(F.trim(F.regexp_replace(source, r"\s*(?:[–—-]\s*)?https?://.*$", ""))),
        "source_url": _filled(F.regexp_extract(source, r"(https?://[^\s）)\]]+)", 1)),
    }


def tags_valid(tags: Column) -> Column:
    """Two to five tags that all begin with ``#``; a NULL list or element is not valid."""
    marked = F.forall(tags, lambda t: F.coalesce(t.startswith("#"), F.lit(False)))
    return F.coalesce(F.size(tags).between(2, 5) & marked, F.lit(False))


def tags_fixed(tags: Column) -> Column:
    """Marks added, defaults appended to fewer than two tags, only the first five kept."""
    defaults = F.array(*[F.lit(t) for t in DEFAULT_TAGS])
    marked = F.transform(F.filter(tags, lambda t: t.isNotNull()),
                         lambda t: F.when(t.startswith("#"), t).otherwise(F.concat(F.lit("#"), t)))
    fixed = F.when(F.size(marked) < 2, F.concat(marked, defaults)).otherwise(F.slice(marked, 1, 5))
    return F.when(tags.isNull(), defaults).when(tags_valid(tags), tags).otherwise(fixed)


def summary_points(summary: Column) -> Column:
    """The first three sentences, without blanks around them."""
    sentences = F.split(F.replace(summary, F.lit("；"), F.lit("。")), "。")
    return F.slice(F.filter(F.transform(sentences, lambda s: F.trim(s, F.lit(BLANKS))), lambda s: s != ""), 1, 3)


def media_and_url(media: Column, url: Column) -> Column:
    return F.concat(media, F.lit(SOURCE_DASH), url)
