import pytest
from pyspark.sql import functions as F

from tidewire.functions import text as X
from tidewire.operators import cards

SPEC = """preamble
选题1
涉及地区/热点： #北方 #港口
标题：港口停电
副标题：夜间恢复
内容：事件：停电；背景：老线路；看点：见选题 2 的后续
时间：2025-09-01
来源：example.com – https://www.example.com/a?b=1

选题2
涉及地区/热点： #南方
标题：桥梁检修
副标题：两周
内容：事件：检修
第二行
时间：2025-09-02
来源：example.org
"""
BODY_FIRST = """好的：

### 选题1

一段正文，
两行。

**标题：** 河水上涨
**副标题：** 低处撤离

**思路：**
说明 1
说明 2

**时间：** 2025年09月02日
**来源：** 某报 – https://news.example.net/x

---

### 选题2

另一段。

**标题：** 新线通车
**副标题：** 首日

**思路：** 短

**时间：** 2025年9月3日
**来源：** example.com
"""
ONE_LINE = """***

### 选题1

**标题：粮价回落 / 三年新低**

**内容：** 正文 https://not.the/source

**思路：** 原因

**时间：** 2025年09月02日
**来源：** example.com

***
"""


def parsed(spark, text):
    return cards.parse_cards(spark.createDataFrame([("f", text)], "name string, text string")).orderBy("pos").collect()


def test_spec_layout(spark):
    a, b = parsed(spark, SPEC)
    assert (a["card_no"], a["tags"], a["title"], a["subtitle"]) == (1, ["#北方", "#港口"], "港口停电", "夜间恢复")
    assert a["content"] == "事件：停电；背景：老线路；看点：见选题 2 的后续"
    assert (str(a["date"]), a["source"], a["source_url"], a["source_domain"]) == (
        "2025-09-01", "example.com", "https://www.example.com/a?b=1", "example.com")
    assert b["content"] == "事件：检修\n第二行" and b["source_url"] is None and b["source_domain"] == "example.org"


def test_body_first_layout(spark):
    a, b = parsed(spark, BODY_FIRST)
    assert (a["content"], a["title"], a["subtitle"], a["angle"]) == ("一段正文，\n两行。", "河水上涨", "低处撤离", "说明 1\n说明 2")
    assert (str(a["date"]), a["source"], a["source_domain"]) == ("2025-09-02", "某报", "news.example.net")
    assert (b["card_no"], b["angle"], str(b["date"])) == (2, "短", "2025-09-03")


def test_one_line_layout(spark):
    (a,) = parsed(spark, ONE_LINE)
    assert (a["title"], a["subtitle"], a["content"], a["source"]) == ("粮价回落", "三年新低", "正文 https://not.the/source", "example.com")
    assert a["source_url"] is None


def test_wide_blank_in_heading(spark):
    (a,) = parsed(spark, "选题　3\n标题：甲\n")
    assert (a["card_no"], a["title"]) == (3, "甲")


def test_no_topic_and_bad_date(spark):
    assert parsed(spark, "只有说明，提到选题 3。") == []
    (a,) = parsed(spark, "选题7\n标题：甲\n时间：2025-02-31\n")
    assert a["date"] is None and a["content"] is None and a["tags"] == []


def test_long_briefing_is_parsed_whole(spark):
    body = "\n".join(f"第 {i} 行，提到选题 4" for i in range(20000))
    (a,) = parsed(spark, f"选题1\n标题：长\n内容：{body}\n时间：2025-01-01\n")
    assert a["content"] == body and str(a["date"]) == "2025-01-01"


@pytest.mark.parametrize("topics,ranges", [
    (10, []), (7, [(8, 10)]), (3, [(4, 8), (9, 10)]), (0, [(1, 5), (6, 10)]), (9, [(10, 10)]), (12, []), (5, [(6, 10)]),
])
def test_completeness(spark, topics, ranges):
    text = "x\n" + "".join(f"选题 {i}\n标题：甲\n" for i in range(1, topics + 1))
    got = cards.completeness(spark.createDataFrame([("f", text)], "name string, text string")).collect()
    assert sorted((r["first_no"], r["last_no"]) for r in got) == ranges


@pytest.mark.parametrize("tags,valid,fixed", [
    (["#a", "#b"], True, ["#a", "#b"]),
    (["a"], False, ["#a", "#新闻", "#时政"]),
    ([], False, ["#新闻", "#时政"]),
    (None, False, ["#新闻", "#时政"]),
    (["a", "#b", "c", "d", "e", "f"], False, ["#a", "#b", "#c", "#d", "#e"]),
    (["#a", None, "b"], False, ["#a", "#b"]),
])
def test_hashtags(spark, tags, valid, fixed):
    row = spark.createDataFrame([(tags,)], "t array<string>").select(X.tags_valid(F.col("t")), X.tags_fixed(F.col("t"))).first()
    assert (row[0], row[1]) == (valid, fixed)


def test_cleanup(spark):
    text = "".join(f"选题{i}\n涉及地区/热点：#a #b\n标题：一二三四五六七八{i}\n副标题：s\n内容：{'长' * 300}\n" for i in (1, 2))
    (card,) = cards.clean_cards(cards.parse_cards(spark.createDataFrame([("f", text)], "name string, text string"))).collect()
    assert (card["card_no"], card["title"], len(card["content"])) == (1, "一二三四五六七八", 200)


def test_summary_points(spark):
    got = spark.createDataFrame([("一； 二。\n三。。四。",)], "s string").select(X.summary_points(F.col("s"))).first()[0]
    assert got == ["一", "二", "三"]


def test_prompt_fills_content_last(spark):
    reports = spark.createDataFrame([("f.json", "{source_filename} 文")], "name string, text string")
    row = cards.prompts(reports, "{source_filename}|{summary_content}").first()
    assert row["prompt"] == "f.json|{source_filename} 文" and row["input_bytes"] == len("{source_filename} 文".encode())


def test_keyword_rule_and_picks(spark):
    rows = spark.createDataFrame([
        ("1", "e1", "war", 0.9), ("2", "e1", "war scandal long", 0.1), ("3", "e2", "calm", 0.5), ("4", "e3", "war insider", 0.4),
        ("5", "e2", "calm and longer", 0.2), ("6", None, None, 0.3)], "id string, event_uri string, body string, final_score_v2 double")
    marked = cards.with_keyword_marks(rows, F.col("body"), ["war"], ["scandal"], ["insider"])
    kept = cards.without_routine_conflict(marked)
    assert sorted(r["id"] for r in kept.collect()) == ["2", "3", "4", "5", "6"]
    assert [r["id"] for r in cards.picks(kept).orderBy("pick_no").collect()] == ["2", "4", "6", "5"]


def test_enough_cards(spark):
    text = "".join(f"选题{i}\n涉及地区/热点：#a #b\n标题：t{i}\n" for i in range(1, 6))
    both = spark.createDataFrame([("full", text), ("half", text[:60])], "name string, text string")
    got = {r["name"]: r["is_enough"] for r in cards.enough_cards(cards.parse_cards(both)).collect()}
    assert got == {"full": True, "half": False}


def test_candidate_cap(spark):
    rows = spark.createDataFrame([("1", "x" * 2000, 0.5)], "id string, body string, final_score_v2 double").withColumn(
        "published_at", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    assert len(cards.candidates(rows, "2025-01-01T12:00:00Z", 1000).first()["body"]) == 1000
    assert cards.candidates(rows, "2025-01-03T12:00:00Z").count() == 0
    with pytest.raises(ValueError):
        cards.candidates(rows, "2025-01-01T12:00:00Z", cap=61)


