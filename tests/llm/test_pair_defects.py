import unicodedata

import pytest

from corpusgate.llm.languages import language, plain_words
from corpusgate.llm.pair_defects import find_pair_defects, pair_defects

ASK, NOTE = "Liệt kê giấy tờ còn thiếu.", "Phiếu số 5: Kho lưu trữ bàn giao biên bản kiểm tra trong thời hạn 3 ngày."
EN, EN_NOTE = "List the papers that are still missing.", "Slip no. 5: The ward office must record a copied form within the week."

CASES = [
    (ASK, NOTE, None, "empty"), (ASK, NOTE, " \xa0\n", "empty"), (ASK, NOTE, "N/A", "empty"), (ASK, NOTE, "[]", "empty"), (ASK, NOTE, "(trống)", "empty"),
    (ASK, NOTE, "Xin lỗi, tôi không thể trả lời câu hỏi này.", "refusal"), (EN, EN_NOTE, "I'm afraid I can't help with that. Please ask someone else.", "refusal"), (EN, "", "No answer can be given by this assistant.", "refusal"),
    (ASK, NOTE, "Je suis désolé, je ne peux pas répondre.", "refusal"),
    (ASK, NOTE, NOTE.upper() + "!", "copied"), (ASK, NOTE, "Câu hỏi: " + ASK, "copied"), (ASK, NOTE, ASK + " " + NOTE, "copied"),
    (ASK, NOTE, "Kho lưu trữ phải bàn giao biên bản kiểm tra trong thời", "truncated"), (ASK, NOTE, '{"don_vi": "kho lưu trữ", "han', "truncated"), (ASK, NOTE, "1. Kho lưu trữ bàn giao.\n2. Bộ đếm cập", "truncated"), (ASK, NOTE, "Kho lưu trữ bàn giao (kể cả biên bản.", "truncated"),
    (ASK, NOTE, "The ward office must record the form and the file within a week.", "other_language"), (EN, EN_NOTE, "Kho lưu trữ phải bàn giao biên bản kiểm tra.", "other_language"), (EN, EN_NOTE, "Le registre du quai est transmis par le greffe et la caution sous 15 jours.", "other_language"),
    (ASK, NOTE, "区公所必须在一周之内登记该表格并归还文件给办事员。", "other_language"),
]
SOUND = [
    (ASK, NOTE, "Có."), (ASK, NOTE, "Nhóm: kho-luu-tru"), (ASK, NOTE, "don_vi: kho lưu trữ\nhan_xu_ly: ba ngày"), (ASK, NOTE, "Xin lỗi vì phản hồi chậm. Kho lưu trữ bàn giao biên bản."), (ASK, NOTE, "Đơn vị từ chối tiếp nhận hồ sơ và không thể thay cho kho."),
    (ASK, NOTE, f"“{NOTE}” Vì vậy cần bổ sung phiếu thu và bảng kê."), ("Dịch phần trả lời sang tiếng Anh.", NOTE, "The ward office must record the form within a week."), (EN, EN_NOTE, '{"unit": "ward office", "due": "a week"}'),
    ("Answer in Vietnamese: what happens next?", "", "Kho lưu trữ phải bàn giao biên bản."), (None, None, "Bảng kê đã được bàn giao."),
]


@pytest.mark.parametrize("i,c,a,defect", CASES)
def test_defects(i, c, a, defect):
    assert (pair_defects(i, c, a) + [None])[0] == defect


@pytest.mark.parametrize("i,c,a", SOUND)
def test_sound(i, c, a):
    assert pair_defects(i, c, a) == []


def test_every_type_that_fires_is_reported():
    assert pair_defects(ASK, NOTE, "The ward office must record the form and the file within a") == ["truncated", "other_language"]


def test_operator(spark):
    rows = [(n, i, c, a, "old") for n, (i, c, a, _) in enumerate(CASES)] + [(99, ASK, NOTE, "Kho lưu trữ. " * 30_000, "old")]
    df = spark.createDataFrame(rows, "id int, instruction string, input string, output string, defect string")
    got = {r.id: r.defect for r in find_pair_defects(df).collect()}
    assert got == {n: d for n, (*_, d) in enumerate(CASES)} | {99: None}
    assert find_pair_defects(df.limit(0)).count() == 0


REASONS = "Files of ongoing proceedings carry duties of discretion towards everyone concerned. Their wording changes often and depends on local practice. "


@pytest.mark.parametrize("i,c,a", [
    (EN, EN_NOTE, "I understand you want the deadline of this slip. I am not able to help with it."),
    (EN, EN_NOTE, "I'm sorry, but I can't help with that. " + REASONS * 6 + "Please ask someone else."),
    (ASK, NOTE, "Cảm ơn bạn đã gửi phiếu này cho tôi. Tôi rất muốn hỗ trợ bạn. Tuy nhiên tôi không thể trả lời câu hỏi này. " + "Bạn nên hỏi một người có chuyên môn. " * 25),
    (EN, EN_NOTE, "I am not able to help with " + "the very long list of papers and slips and forms that you have sent " * 6 + "today."),
])
def test_refusals_of_any_length_and_place(i, c, a):
    assert pair_defects(i, c, a)[:1] == ["refusal"]


@pytest.mark.parametrize("i,c,a", [
    (EN, EN_NOTE, "The ward office must record a copied form within the week. I cannot comment on other slips."),
    (EN, EN_NOTE, "I cannot comment on other slips. The ward office must record a copied form within the week."),
    (EN, EN_NOTE, "The clerk answered: “I cannot help with that.” The form must then be recorded within the week."),
])
def test_answers_with_a_refusal_beside_them(i, c, a):
    assert pair_defects(i, c, a) == []


@pytest.mark.parametrize("i,c,a,defect", [
    (EN, EN_NOTE, unicodedata.normalize("NFD", "Xin lỗi, tôi không thể trả lời câu hỏi này."), "refusal"),
    (EN, EN_NOTE, "Mi dispiace, ma non posso rispondere a questa domanda.", "refusal"), (EN, EN_NOTE, "Infelizmente não posso ajudar com isso.", "refusal"),
    (EN, EN_NOTE, "Il modulo deve essere consegnato allo sportello entro dieci giorni dalla richiesta.", "other_language"),
    (EN, EN_NOTE, "Formulier en kopie worden binnen tien dagen bij het gemeentehuis ingeleverd.", "other_language"),
    (ASK, NOTE, "Papan nama di luar batas menjaga pemilik kios; lalu meteran air yang rusak menunda tim gabungan.", "other_language"),
    (ASK, NOTE, "*** " * 40 + "N/A" + " ***" * 40, "empty"),
    (ASK, NOTE, "Câu hỏi mà bạn đã gửi: " + NOTE, "copied"), (ASK, NOTE, NOTE[:60], "copied"),
    (EN, EN_NOTE, "1. The ward office records the form.\n2. The clerk returns it.\n3. ", "truncated"),
    (EN, EN_NOTE, "The office said “record the form within the week. The clerk returns it.", "truncated"), (EN, EN_NOTE, "The clerk (of the office (north) records the form. Then it is returned.", "truncated"),
    (EN, EN_NOTE, "Run this:\n```\nrecord form\n", "truncated"), (EN, EN_NOTE, '{"unit": "ward {office", "due": "a week"', "truncated"),
])
def test_forms_languages_and_delimiters(i, c, a, defect):
    assert defect in pair_defects(i, c, a)


@pytest.mark.parametrize("a", [
    "“The ward office records the form within the week.", "The clerk [of the office) records the form.", '{"unit": "ward (office", "due": "a week"}', "The form is due in week\n3.", "a) The office records it.\nb) The clerk returns it.",
    "Tray: an-audit-trail-under-review", "The rule is: x < 5 and y } 3.",
])
def test_whole_answers_with_odd_marks(a):
    assert pair_defects(EN, EN_NOTE, a) == []


def test_languages_of_sentences_outside_the_samples():
    said = {
        "en": "The committee postponed its decision because several papers were missing.", "fr": "Le comité a reporté sa décision car plusieurs documents manquaient.", "es": "El comité aplazó su decisión porque faltaban varios documentos.",
        "pt": "O comitê adiou a sua decisão porque faltavam vários documentos.", "it": "Il comitato ha rinviato la decisione perché mancavano diversi documenti.", "de": "Der Ausschuss verschob seine Entscheidung, weil mehrere Unterlagen fehlten.",
        "nl": "De commissie stelde haar beslissing uit omdat verschillende stukken ontbraken.", "id": "Panitia menunda keputusan karena beberapa surat belum lengkap.", "sv": "Kommittén sköt upp sitt beslut eftersom flera handlingar saknades.",
        "pl": "Komisja odroczyła swoją decyzję, ponieważ brakowało kilku dokumentów.", "tr": "Kurul, birkaç belge eksik olduğu için kararını erteledi.", "ro": "Comitetul a amânat decizia pentru că lipseau mai multe documente.", "vi": "Ủy ban đã hoãn quyết định vì còn thiếu một số giấy tờ.",
        "CYRILLIC": "Комитет отложил решение.", None: "OK 12",
    }
    found = {k: language(plain_words(t)) for k, t in said.items()}
    # held-out accuracy: short sentences may stay undecided, but none is taken for another language
    assert {k: v for k, v in found.items() if v not in (k, None)} == {}
    assert sum(k == v for k, v in found.items()) >= 13
