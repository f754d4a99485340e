import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusgate.llm import mojibake_pairs
from corpusgate.llm.mojibake import READ_AS, _read, legacy_writers, repair, repair_encoding, rimes

WORDS = "Hội đồng thẩm định chờ xác minh; Điều 5 của Luật thuế Ắc quy, nhà ở tại Đắk Lắk".split()


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "cp1258", "cp437", "mac_roman", "cp1250"])
def test_utf8_read_as_single_byte_comes_back(encoding):
    text = " ".join(WORDS)
    assert repair(_read(text.encode(), encoding)) [0] == text


@pytest.mark.parametrize("first,second", [("cp1252", "cp1252"), ("latin-1", "cp1252"), ("cp1252", "latin-1")])
def test_twice_garbled_comes_back(first, second):
    text = " ".join(WORDS)
    assert repair(_read(_read(text.encode(), first).encode(), second))[0] == text


@pytest.mark.parametrize("name", ["vni", "tcvn", "viscii"])
def test_vietnamese_single_byte_encodings(name):
    text = "khu vực đệm lần đầu được miễn giảm"
    restored, n = repair(legacy_writers()[name](text))
    assert n > 2 and restored == text


@pytest.mark.parametrize("text", [
    "Nguồn điện (ký hiệu β và π)", "ở 25 °C ± 2", "nhãn hiệu “Café Âme”", "tên cũ: Señor Pão", "dầu mỡ naïve, façade", "phí 40 €", "«порядок учёта»", "– ĐÃ XÁC NHẬN TẠI XÃ", "hệ số α bằng ½, diện tích 120 m²", "“ĐÃ”", "Où été là", "",
    "straße über Köln", "① và ②", "plain ascii",
])
def test_correct_text_is_left_alone(text):
    assert repair(text) == (text, 0)


def test_only_matched_spans_change():
    restored, n = repair("Vườn ươm «а» bằng giáº¥y, café")
    assert restored == "Vườn ươm «а» bằng giấy, café" and n == 1


def test_lost_bytes():
    assert repair("NgÆ°á»?i giÃ¡m há»™")[0] == "Người giám hộ"
    restored, n = repair("thá»� giÃ¡m")
    assert n >= 2 and "giám" in restored


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(sorted(r for r in rimes() if not r.isascii())), min_size=3, max_size=8), st.sampled_from(READ_AS[:3]))
def test_round_trip_of_any_syllables(parts, encoding):
    text = " ".join(f"th{p}" for p in parts)
    assert repair(_read(text.encode(), encoding))[0] == text


def test_operator_with_nulls_copies_and_clashing_names(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "giáº¥y", None), (3, "giáº¥y", None), (4, "giấy", "quÃ¡ háº¡n"), (5, "giáº¥y " * 20_000, "x")]
    df = spark.createDataFrame(rows, "id int, text string, spans_text string")
    got = sorted((r.id, r.field_name, r.restored_text[:9]) for r in repair_encoding(df, ["text", "spans_text"], ["id"]).collect())
    assert got == [(3, "text", "giấy"), (3, "text", "giấy"), (4, "spans_text", "quá hạn"), (5, "text", "giấy giấy")]
    assert repair_encoding(df.limit(0), ["text"], ["id"]).count() == 0


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "cp437"])
@pytest.mark.parametrize("text", ["Hội đồng thẩm định", "ภาษี", "ok 😀 👍"])
def test_marks_and_further_scripts_come_back(encoding, text):
    text = unicodedata.normalize("NFD", text)
    assert repair(_read(text.encode(), encoding))[0] == text


@pytest.mark.parametrize("encoding", READ_AS)
def test_read_twice_in_every_encoding(encoding):
    text = "Hội đồng thẩm định"
    assert repair(_read(_read(text.encode(), encoding).encode(), encoding))[0] == text


def test_a_short_stretch_among_foreign_names():
    names = "tên Señor Pão Köln façade naïve über Ångström Gödel "
    assert repair(names + legacy_writers()["tcvn"]("được miễn giảm"))[0] == names + "được miễn giảm"
    assert repair(names) == (names, 0)


LEGACY = legacy_writers()


@pytest.mark.parametrize("garbled,right", [
    ("các bên tham gia hợp đồng " + LEGACY["tcvn"]("khu vực đệm lần đầu được miễn giảm"), "các bên tham gia hợp đồng khu vực đệm lần đầu được miễn giảm"),
    (LEGACY["tcvn"]("khu vực đệm được áp phích lần đầu") + " và " + _read("Hội đồng thẩm định".encode(), "cp1252"), "khu vực đệm được áp phích lần đầu và Hội đồng thẩm định"),
    (LEGACY["tcvn"]("khu vực đệm lần đầu") + ". " + LEGACY["vni"]("thẻ các điều khoản được nộp"), "khu vực đệm lần đầu. thẻ các điều khoản được nộp"),
    ("diện tích 120 m² của " + LEGACY["viscii"]("khu vực đệm lần đầu được miễn giảm"), "diện tích 120 m² của khu vực đệm lần đầu được miễn giảm"),
    ("tên gọi " + _read("你好世界合同".encode("gb2312"), "latin-1") + " là", "tên gọi 你好世界合同 là"),
    ("tên gọi " + _read("Договор поставки".encode("cp1251"), "cp1252") + " là café", "tên gọi Договор поставки là café"),
    (_read("Σύμβαση εργασίας".encode("cp1253"), "cp1252"), "Σύμβαση εργασίας"), (_read("안녕하세요".encode("euc_kr"), "cp1252"), "안녕하세요"),
])
def test_each_stretch_by_its_own_encoding(garbled, right):
    assert repair(garbled)[0] == right


@pytest.mark.parametrize("text", ["порядок учёта и договор", "Σύμβαση εργασίας", "ÀÉÎ ÖÄÜ straße Ærøskøbing", "契約書です 계약서 合同", "Îles Éparses, Åland, Çeşme, Łódź"])
def test_other_scripts_and_names_are_left_alone(text):
    assert repair(text) == (text, 0) and mojibake_pairs.find(text) == []


def test_share_of_correct_words_changed_in_mixed_text():
    """Correct sentences of syllables beside garbled ones, each by itself decidable: none of the correct words may change."""
    rng = random.Random(4)
    syllables = "hồ sơ phải được gửi đến tổ tiếp nhận trong thời hạn ba ngày kể từ khi bên liên quan ký biên bản bàn giao tại trụ sở cơ quan cấp huyện".split()
    changed = total = 0
    for k in range(300):
        right = [rng.choice(syllables) for _ in range(12)]
        bad = " ".join(rng.choice(syllables) for _ in range(10))
        garbled = LEGACY[("tcvn", "vni", "viscii")[k % 3]](bad) if k % 2 else _read(bad.encode(), READ_AS[k % 3])
        got = repair(" ".join(right) + ". " + garbled)[0].split(" ")[: len(right)]
        changed += sum(a.strip(".") != b for a, b in zip(got, right))
        total += len(right)
    assert changed <= total * 0.002
