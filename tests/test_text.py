"""Literal cases of the text functions that the test tables don't hold."""

import random

from pyspark.sql import functions as F

from tidemark.functions import arrow, dates, identity as I, keywords as K, text as T

MARKS = ["HOUSE COPY", "CH99"]


def value(spark, column, **row):
    names, values = zip(*row.items()) if row else (("x",), (0,))
    return spark.createDataFrame([values], ", ".join(f"{n} {'string' if isinstance(v, (str, type(None))) else 'int'}" for n, v in zip(names, values))).select(column.alias("v")).first()["v"]


def test_noise_lines(spark):
    def noise(line):
        return value(spark, T.is_noise(F.col("t"), MARKS), t=line)

    assert noise("HOUSE COPY")
    assert noise("-----")
    assert noise("= = =")
    assert not noise("")
    assert not noise("12")
    assert not noise("a long sentence that only mentions HOUSE COPY in passing, with more than eighty characters in all")
    assert value(spark, T.without_marks("t", MARKS), t="read  this CH99 now") == "read this now"


def test_noisy_and_labels(spark):
    assert value(spark, T.is_noisy(F.col("t")), t="abc���")
    assert value(spark, T.is_noisy(F.col("t")), t="#$%&" * 6)
    assert not value(spark, T.is_noisy(F.col("t")), t="short")
    assert value(spark, T.is_chart_label(F.col("t")), t="-12.50%")
    assert value(spark, T.is_chart_label(F.col("t")), t="03/24")
    assert not value(spark, T.is_chart_label(F.col("t")), t="an ordinary line")


def test_empty_text_is_all_noise(spark):
    row = T.quality(spark.createDataFrame([("",)], "t string"), "t", MARKS, []).first()
    assert (row.repeated_ratio, row.watermark_ratio, row.noise_ratio) == (1.0, 1.0, 1.0)
    assert (row.chars, row.nonempty_lines, row.max_line, row.meaningful) == (0, 0, 0, 0)


def test_gate(spark):
    good = "\n".join(f"Line {i} holds an ordinary sentence about a subject worth reading, number {i * 7}." for i in range(30))
    docs = spark.createDataFrame([("good", good), ("repeats", "\n".join(["The same line again and again, word for word."] * 60)), ("long", "x" * 3000), ("short", "too short")], "k string, t string")
    own = {r.k: r.ok for r in T.quality(docs, "t", MARKS, ["k"]).withColumn("ok", T.acceptable()).collect()}
    assert own == {"good": True, "repeats": False, "long": False, "short": False}


def test_repeats_counts_all_copies(spark):
    assert value(spark, T.repeats(F.split("t", ",")), t="a,b,a,c,a,b") == 5
    assert value(spark, T.repeats(F.split("t", ",")), t="a,b,c") == 0


def test_clean(spark):
    body = "a sentence of more than eighty characters that goes on and on, beside the mark"
    raw = f"# Title\r\n\r\n\r\n\r\nHOUSE COPY\r\n{body} CH99 text\r\n-----\r\nshort CH99\r\nend"
    assert value(spark, T.clean("t", MARKS), t=raw) == f"# Title\n\n{body} text\nend"
    assert value(spark, T.max_line_length(T.clean("t", MARKS, 10)), t="y" * 35) == 10


def test_budget_ends_at_the_first_line_that_does_not_fit(spark):
    assert value(spark, T.within_budget("t", 10), t="abc\nabcdefgh\nab") == "abc"


def test_tail_of_few_lines(spark):
    assert value(spark, T.tail("t"), t="a\n\nb") == "a | b"
    assert value(spark, T.tail("t", 2), t="a\nb\nc") == "b | c"


def test_keyword_boundaries(spark):
    assert value(spark, K.mentions("t", ["ai"]), t="AI, said ai; maintain a-i") == 2
    assert value(spark, K.contains("t", "电力"), t="看好电力板块")
    assert not value(spark, K.contains("t", ""), t="x")
    assert value(spark, K.alias_mentions("t", ["高通"], {"高通": "胀膨"}), t="高通发布，高通胀") == 1
    assert value(spark, K.first_index("t", ["zz", "b"]), t="aab") == 3
    assert value(spark, K.first_index("t", ["zz"]), t="aab") is None


def test_query_tokens():
    assert K.query_tokens("AI 电力需求增长", grams=(3,)) == ["AI", "电力需求增长", "电力需", "力需求", "需求增", "求增长"]
    assert K.query_tokens("什么影响 power", stop=("什么", "影响")) == ["power"]


def test_dates(spark):
    assert value(spark, dates.date_in("t", 2027), t="report 2024-02-30, then 240229") == "2024-02-29"
    assert value(spark, dates.date_in("t", 2027), t="note 20240315 x") == "2024-03-15"
    assert value(spark, dates.date_in("t", 2027), t="no date") is None
    assert value(spark, dates.fixed_backoff("n"), n=9) == 20
    assert value(spark, dates.exponential_backoff("n"), n=4) == 180


def test_identity(spark):
    assert value(spark, I.blank("t"), t="  ") is None
    assert value(spark, I.report_id("t", F.lit("p")), t="ABCDEF0123456789ff") == "doc_abcdef0123456789"
    assert value(spark, I.report_id("t", F.lit("p")), t="short").startswith("local_")
    assert value(spark, I.title_similarity("t", "c"), t="alphabeta", c="alphabetagamma") == 1.0
    a, b = value(spark, I.title_similarity("t", "c"), t="abcx", c="abcdefgh"), value(spark, I.title_similarity("t", "c"), t="abcdefgh", c="abcx")
    assert a > b  # the shares are of the target


def test_arrow_functions():
    assert arrow.last_json('x {"a": 1} y {"b": {"c": 2}} {broken') == '{"b":{"c":2}}'
    assert arrow.last_json("nothing") is None
    assert arrow.merge_chunks(["a\nb\nc", "B\nc\nd", ""]) == "a\nb\nc\n\nd"
    assert arrow.merge_chunks(["Section 05", "Section 10"]) == "Section 05\n\nSection 10"
    assert arrow.folded_key("Ｒeport①.PDF") == "report1"
    assert arrow.folded_key("--.pdf") == "--"
    assert arrow.values_of({"a": [{"id": 1}, {"b": {"id": "x"}}], "id": None}, "id") == ["1", "x", "None"]


def test_hashed_counts_give_the_signed_cosine():
    import hashlib

    def signed(text):
        out = {}
        for t in text.split():
            raw = int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "big")
            out[raw % 512] = out.get(raw % 512, 0) + (-1 if raw & 1 else 1)
        return out

    def cosine(a, b):
        return sum(v * b.get(k, 0) for k, v in a.items()) / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5

    a, b = "alpha beta gamma alpha", "beta gamma delta"
    assert abs(cosine(signed(a), signed(b)) - cosine(arrow.embedding(a), arrow.embedding(b))) < 1e-12


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f("t").alias("x")).first().x


def wrap_slowly(line, width):
    out = []
    while len(line) > width:
        cut = line.rfind(" ", 0, width + 1)
        cut = cut if cut >= width // 2 else width
        out.append(line[:cut].rstrip())
        line = line[cut:].lstrip()
    return [x for x in [*out, line] if x]


def test_lines_are_wrapped_at_the_last_space_past_the_middle(spark):
    assert one(spark, "aaaa bbbb cccc", lambda t: T.hard_wrap(t, 10)) == ["aaaa bbbb", "cccc"]
    assert one(spark, "a" * 25, lambda t: T.hard_wrap(t, 10)) == ["a" * 10, "a" * 10, "a" * 5]
    assert one(spark, "", lambda t: T.hard_wrap(t, 10)) == [""]
    r = random.Random(4)
    for _ in range(30):
        line = " ".join("".join(r.choice("ab文\U0001f600") for _ in range(r.choice([1, 3, 9, 40]))) for _ in range(60))
        assert one(spark, line, lambda t: T.hard_wrap(t, 30)) == wrap_slowly(line, 30)
    words = " ".join(f"Section {i:03d} explains revenue growth margin pressure" for i in range(120))
    for long in (words, "半导体需求恢复库存压力价格变化资本开支下游订单改善" * 180):
        own = one(spark, long, lambda t: T.clean(t, [])).split("\n")
        assert len(own) > 1 and max(map(len, own)) <= 1200
        assert own == wrap_slowly(long, 1200)


def test_dates_with_every_separator(spark):
    for text, wanted in {
        "2024年05月06日": "2024-05-06", "x 2024-05-06": "2024-05-06", "2024/05/06": "2024-05-06", "2024.05.06": "2024-05-06", "20240506": "2024-05-06", "240506": "2024-05-06",
        "20240230 then 240506": "2024-05-06", "12024-05-06": None, "2024-13-06": None, "nothing": None, "": None, "1999-05-06": None,
    }.items():
        assert one(spark, text, lambda t: dates.date_in(t, 2027)) == wanted, text


def test_figures_companies_and_highlights(spark):
    assert one(spark, "grew 12.5% to $3.2B", K.key_numbers) == ["grew 12.5% to $3.2B"]
    far = "a" * 30 + " 5%" + " b" * 30 + "7 GWh"
    assert one(spark, far, K.key_numbers) == ["a" * 23 + " 5%" + " b" * 12, "b " * 11 + "b7 GWh"]
    assert one(spark, "5美元/桶", K.key_numbers) == ["5美元/桶"] and one(spark, "5 apples", K.key_numbers) == []
    assert one(spark, "Acme Corp: strong quarter", K.companies_in) == ["Acme Corp"]
    assert one(spark, "Ab ab AB abc", lambda t: K.highlight(t, ["ab"])) == "[Ab] [ab] AB abc"
    assert one(spark, "a $1 (b) $1", lambda t: K.highlight(t, ["(b)", "$1"], 1)) == "a [$1] [(b)] $1"
    assert one(spark, "no\nmatch", lambda t: K.highlight(t, ["x", ""])) == "no\nmatch"
