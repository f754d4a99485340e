import unicodedata

from corpusgate.llm.lookalikes import Rewriter, classes, frequencies, representatives, unify_lookalikes

REWRITE = Rewriter(representatives({c: 5 for c in "aceopxyvàáậớ "})).rewrite


def test_forms_become_one():
    plain = "Thông tư diễn tập về thửa đất"
    forms = [
        unicodedata.normalize("NFD", plain), plain.replace(" ", "\xa0"), plain.replace("T", "Ｔ").replace("g", "ｇ"), plain.replace("v", "ν"), plain.replace("a", "а").replace("T", "Т"), plain.replace("h", "h\u200b"), "\ufeff" + plain,
        plain.replace("đ", "d\u0336"), unicodedata.normalize("NFD", plain).replace("o", "о"), plain.replace("t", "t\xad"),
    ]
    for f in forms:
        got, places = REWRITE(f)
        assert got == plain and places, ascii(f)
    assert REWRITE(plain) == (plain, 0)


def test_marks_in_any_order_and_half_composed():
    for s in ("a\u0323\u0302", "a\u0302\u0323", "â\u0323", "ạ\u0302"):
        assert REWRITE(s)[0] == "ậ"


def test_symbols_and_foreign_words_stay():
    for s in ("«порядок учёта»", "ký hiệu β và π", "hệ số α bằng ½", "120 m² và 3 m³", "① và ②", "ν", "5 µm, 10 Ω", "Señor Pão"):
        assert REWRITE(s) == (s, 0)


def test_classes_are_transitive_and_disjoint():
    c = classes()
    assert c["а"] is c["ａ"] is c["a"]
    assert len({id(x) for x in c.values()}) == len(set(c.values()))
    rep = representatives({})
    assert rep["а"] == "a" and rep["\u200b"] == "" and rep["\xa0"] == " " and rep["Ð"] == "Đ"


def test_operator(spark):
    rows = [(1, "Ｖé", None), (2, None, ""), (3, "thường", "ＯＫ"), (3, "thường", "ＯＫ"), (4, "giáº¥y\xa0tờ", "x"), (5, "chờ\u200b " * 20_000, "x")]
    df = spark.createDataFrame(rows, "id int, text string, places_col string")
    out = unify_lookalikes(df, ["text", "places_col"], ["id"])
    got = sorted((r.id, r.field_name, r.unified_text[:5]) for r in out.where("not garbled").collect())
    assert got == [(1, "text", "Vé"), (3, "places_col", "OK"), (3, "places_col", "OK"), (5, "text", "chờ c")]
    assert [r.id for r in out.where("garbled").collect()] == [4]
    assert unify_lookalikes(df.limit(0), ["text"], ["id"]).count() == 0
    assert frequencies(df, ["text"])["\u200b"] == 20_000


def test_joiners_and_variations_stay_where_they_shape_something():
    for s in ("می‌خواهم", "\U0001f468‍\U0001f469‍\U0001f467", "❤️", "1️⃣", "क्‍ष"):
        assert REWRITE(s) == (s, 0), ascii(s)
    for s, want in (("2‍3 ngày", "23 ngày"), ("x️y", "xy"), ("Điều⁪ 1", "Điều 1"), ("a\U000e0041b", "ab"), ("dòng sau", "dòng\nsau")):
        assert REWRITE(s)[0] == want, ascii(s)


def test_further_scripts_and_letters_written_as_one():
    assert REWRITE("ᎪᏢᏢle")[0] == "APPle" and REWRITE("ꓮꓐꓚ")[0] == "ABC" and REWRITE("ﬁnal ﬂow")[0] == "final flow" and REWRITE("ᴄode")[0] == "code"
    assert REWRITE("ᏣᎳᎩ")[0] == "ᏣᎳᎩ"


def test_strings_are_counted_and_decide(spark):
    df = spark.createDataFrame([("á b á ậ đ",), (None,), ("aa",)], "t string")
    n = frequencies(df, ["t"])
    assert n["á"] == 2 and n["ậ"] == 1 and n["a"] == 2
    rep = representatives({"ﬁ": 9, "fi": 1})
    assert rep["ﬁ"] == "fi" and rep["á"] == "á"
