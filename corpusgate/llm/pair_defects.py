"""Broken prompt and response pairs.

Ordered rules look at an answer beside its instruction and input. Every rule
that fires is reported; the order of the rules decides which one names the
pair. The rules run over Arrow batches of the three columns in one scan: as
column expressions the same rules took six times the CPU, most of it in
regular expressions and lambdas that the JVM interprets.
"""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .languages import language, plain_words

# Answers that stand for no answer, as letters and digits only.
PLACEHOLDERS = [
    "na", "none", "null", "nil", "nan", "empty", "blank", "tbd", "tba", "todo", "undefined", "placeholder",
    "noanswer", "nooutput", "noresponse", "nocontent", "nodata", "notavailable", "notapplicable", "emptyanswer",
    "leftblank", "tobedetermined", "answerhere", "pending", "xxx",
    "trống", "đểtrống", "rỗng", "khôngcó", "khôngcónộidung", "khôngcódữliệu", "khôngcócâutrảlời", "khôngcótrảlời",
    "chưacó", "chưacónộidung", "chưacócâutrảlời", "chưatrảlời", "chưacậpnhật", "đangcậpnhật", "cậpnhậtsau", "bổsungsau",
    "vide", "néant", "aucuneréponse", "sinrespuesta", "kosong", "leer",
]

# How a refusal is worded, first person or passive, by language.
_VI_SELF = r"(?:tôi|em|mình|chúng tôi|chúng em|hệ thống|trợ lý)"
_VI_WORK = r"(?:trả lời|giúp|hỗ trợ|đáp ứng|cung cấp|thực hiện|đưa ra|bàn|thảo luận|soạn|viết|xử lý yêu cầu|làm (?:việc|điều)|tư vấn|tiết lộ|bình luận)"
REFUSALS = [
    _VI_SELF + r" (?:rất tiếc |hiện |đành |buộc |đang )?(?:không thể|chưa thể|không được phép|không được quyền|không có quyền|không có khả năng|không đủ khả năng) (?:[^\W\d_]+ ){0,3}?" + _VI_WORK,
    r"(?:không thể|chưa thể) (?:giúp|hỗ trợ|đáp ứng|trả lời) (?:bạn|được|quý|câu hỏi này|yêu cầu|việc)",
    _VI_SELF + r" (?:buộc phải|xin phép|xin|phải|đành|cần) (?:được )?(?:từ chối|không (?:đưa|trả|cung|hỗ|giúp|thực|bàn|soạn|bình|tư|nêu|tiết))",
    _VI_SELF + r" (?:xin )?từ chối (?:trả lời|soạn|cung cấp|thực hiện|hỗ trợ|yêu cầu|đưa ra|viết)",
    r"^ (?:[^\W\d_]+ ){0,3}?xin (?:phép )?(?:được )?từ chối (?:trả lời|soạn|cung cấp|thực hiện|hỗ trợ|yêu cầu|câu hỏi|đưa ra|viết)",
    _VI_SELF + r" (?:không|sẽ không) (?:đưa ra|nêu|cung cấp|bình luận|trả lời|bàn|viết|soạn|hỗ trợ|tư vấn)",
    r"(?:nằm ngoài|vượt quá|ngoài) (?:khả năng|phạm vi|thẩm quyền|quyền hạn)(?: [^\W\d_]+){0,3}? của " + _VI_SELF,
    r"(?:câu hỏi|yêu cầu|nội dung|việc) này (?:tôi |em )?(?:không thể|không được) (?:[^\W\d_]+ ){0,2}?(?:trả lời|đáp ứng|cung cấp|hỗ trợ|thực hiện)",
    r" i(?: am|m)? (?:[^\W\d_]+ ){0,2}?(?:cannot|can not|cant|could not|couldnt|wont|will not|must not|may not|do not|dont|not able to|unable to|not allowed to|not permitted to|not in a position to|have to decline|must decline|need to decline|decline to|refuse to|would rather not|prefer not to)(?= )",
    r" i (?:[^\W\d_]+ ){0,2}?(?:have to|must|need to|will have to) (?:[^\W\d_]+ ){0,2}?(?:decline|refuse|pass)(?= )",
    r" (?:this|that|it) (?:is|request is|question is)? ?(?:[^\W\d_]+ ){0,2}?(?:i have to decline|i must decline|i cannot|i cant|beyond my|outside what i|outside my)",
    r" (?:falls|is|lies) (?:outside|beyond) (?:what i|my|the scope of what i)(?= )",
    r" no (?:answer|help|reply|response|advice) can be (?:given|provided|offered)(?= )",
    r" as an? (?:ai|language model|assistant|automated)(?= )",
    r" (?:request|question) (?:cannot|can not|cant) be (?:answered|fulfilled|processed)(?= )",
    r" (?:we|this assistant|the assistant|this system) (?:cannot|can not|cant|is not able|are not able|is unable|are unable|will not|wont|must decline)(?= )",
    r" je (?:suis désolée? mais je )?(?:ne (?:peux|suis|pourrai|saurais)|n ai pas le droit|dois (?:refuser|décliner)|refuse|regrette)(?= )",
    r" (?:no puedo|lo siento no|no me es posible|debo (?:rechazar|declinar))(?= )",
    r" (?:saya|kami) (?:[^\W\d_]+ ){0,2}?(?:tidak (?:dapat|bisa|boleh)|terpaksa menolak|harus menolak)(?= )",
    r" ich (?:kann|darf|muss) (?:[^\W\d_]+ ){0,3}?(?:nicht|ablehnen)(?= )",
    r" (?:não (?:posso|consigo|me é possível)|lamento mas não) (?:[^\W\d_]+ ){0,2}?(?:ajudar|responder|fornecer|atender|cumprir)(?= )",
    r" (?:non posso|non mi è possibile|devo rifiutare) (?:[^\W\d_]+ ){0,2}?(?:aiutare|aiutarti|aiutarla|rispondere|fornire|soddisfare)(?= )",
    r" ik (?:kan|mag|wil) (?:[^\W\d_]+ ){0,4}?niet (?:[^\W\d_]+ ){0,2}?(?:helpen|beantwoorden|geven)(?= )",
    r"죄송하지만|(?:도와드릴|답변할|제공할) 수 없|抱歉|无法(?:回答|提供|帮助)|不能(?:回答|提供)|申し訳|お答えできません|не могу (?:ответить|помочь)|вынужден отказать",
]

# Courtesies that may stand before a refusal or an answer.
_COURTESY = (
    r"^(?:(?:dạ|vâng|thưa bạn|xin lỗi(?: bạn)?|rất tiếc(?: là)?|thật tiếc|rất xin lỗi|cảm ơn bạn(?: đã hỏi)?|tuy vậy|tuy nhiên|nhưng|tôi hiểu yêu cầu này|tôi hiểu|tôi e rằng|"
    r"(?:i am |i m |im )?(?:very |so |really )?sorry|unfortunately|i am afraid(?: that)?|i m afraid(?: that)?|im afraid(?: that)?|thank you for asking|thanks for asking|thank you|thanks|apologies|my apologies|but|however|i understand(?: the| your| this)?(?: request| question)?|"
    r"désolée?|malheureusement|lo siento|maaf|leider) )+"
)
_LANGUAGES = (
    r"tiếng (?:anh|việt|pháp|trung|hoa|nhật|hàn|đức|nga|tây ban nha|indonesia|thái|lào|khmer)|"
    r"(?:english|vietnamese|french|chinese|japanese|korean|german|russian|spanish|indonesian|thai|italian|portuguese|dutch|swedish|polish|turkish|romanian|malay|hindi|arabic|greek)|"
    r"(?:anglais|vietnamien|français|inglés|vietnamita)"
)
_ASKED = r"(?:\b(?:in|into|to|using|en|em|auf|bằng|sang|qua|ra|thành|dùng)\s+(?:the\s+)?(?:" + _LANGUAGES + r"))|\b(?:translate|translation|dịch|traduis|traduire|traduce|terjemahkan)\b"

# Words of sentences that speak of the request, of who asks or declines, or of whom to ask instead. They answer nothing.
_ASIDE = (
    r" (?:tôi|em|mình|bạn|quý|anh chị|vui lòng|mong|hãy|xin|yêu cầu|câu hỏi|trả lời|phụ trách|chuyên môn|lý do|chính sách|thông cảm|đây|này|điều đó|việc đó|"
    r"i|im|id|me|my|we|our|you|your|please|sorry|thanks|try|ask|request|requests|question|questions|person in charge|policy|policies|safety|assistant|advice|this|that|it|these|such|"
    r"je|moi|vous|votre|demande|yo|usted|su pregunta|saya|anda|ich|sie|ihre)(?= )"
)

# Any of these must stand in an answer before it is worth matching the refusals.
_TELLING = ["tôi", "em ", "mình", "chúng", "hệ thống", "trợ lý", "xin", "không thể", "chưa thể", "này", " i ", " im ", " my ", "no ", " as a", "cannot be", "can not be", "cant be", " we ", "assistant", "system", " je ", "puedo", "siento", "posible", "debo", "saya", "kami", " ich ", "não", "non ", "devo", " ik ", "죄송", "수 없", "抱歉", "无法", "不能", "申し訳", "お答え", "не могу", "вынужден"]
# And one of these, for every way to refuse holds one.
_DENYING = ["không", "chưa thể", "từ chối", "ngoài", "vượt quá", "cannot", " not ", " cant ", "couldnt", "wont", "dont", "unable", "decline", "refuse", " pass ", "beyond", "outside", "can be", " as a", " je ", "puedo", "siento", "posible", "debo", "tidak", "menolak", "não", "non ", "devo", "niet", "죄송", "수 없", "nicht", "ablehnen", "抱歉", "无法", "不能", "申し訳", "お答え", "не могу", "вынужден"]

RULES = ["empty", "refusal", "copied", "truncated", "other_language"]

_refusal = re.compile("|".join(REFUSALS))
_refusal_anywhere = re.compile("|".join(r.removeprefix("^") for r in REFUSALS))
_aside = re.compile(_ASIDE)
_quoted = re.compile("“[^”]*”|«[^»]*»|\"[^\"]*\"")
_courtesy = re.compile(_COURTESY.replace("^", "^ ", 1))
_asked = re.compile(_ASKED)
_sentence_end = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")
_lead = re.compile(r"^[\W_]*((?:[^\W_]++[^\w\n:：]*+_*+){1,8})[:：]")
_json = re.compile(r"^[{\[]\s*[\"{\[\]}]")
_json_string = re.compile(r'"(?:[^"\\]|\\.)*"')
_dangling = re.compile(r"[,;:(\[{/–—\-、，：；（]$")
_item = re.compile(r"^[ \t]*(?:(\d+)[.)]|[-*•–])(?=\s|$)", re.M)
_closed = re.compile(r"[.!?…。！？\"”’'»)）\]}*_`>]$")
_field = re.compile(r"^[\W_]*\w+(?: \w+){0,2}\s*[:=]\s*\S")
_label = re.compile(r"^[^\w\n]*\w+(?: \w+)?[ \t]*[:=\-–—][ \t]*\S+(?: \S+)?$")

def _refuses(answer: str, spoken: str, context: str) -> bool:
    """Some sentence of the answer refuses, outside quotation marks, and none answers; ``spoken`` has the answer's words.

    A sentence answers if it has over three words after courtesies and speaks
    neither of the request nor of who asks or declines. After a refusal it may
    still be a reason for it: there it answers only if half of its words are
    those of the context, or if there is no context to tell by.
    """
    if not any(map(spoken.__contains__, _DENYING)) or not any(map(spoken.__contains__, _TELLING)):
        return False
    own = _quoted.sub(" ", answer)
    if not plain_words(own).strip():
        own = answer
    if not _refusal_anywhere.search(spoken if own == answer else plain_words(own)):
        return False
    known = set(plain_words(context).split())
    refused = False
    for sentence in _sentence_end.split(own.strip()):
        said = _courtesy.sub(" ", plain_words(sentence))
        if _refusal.search(said):
            refused = True
        elif said.count(" ") > 4 and not _aside.search(said):
            words = said.split()
            if not refused or not known or 2 * sum(w in known for w in words) >= len(words):
                return False
    return refused


def _copies(answer: str, kept: str, sources: list[str]) -> bool:
    """All letters and digits of the answer come from the prompt, but for a lead-in of up to eight words before a colon.

    An answer that stops within a prompt it copies counts if it gets past the prompt's half.
    """
    lead = _lead.match(answer)
    led = plain_words(lead[1]).replace(" ", "") if lead else None
    forms = [kept, kept[len(led) :]] if led else [kept]
    for source in sources:
        if source and any(x == source or (2 * len(x) > len(source) and source.startswith(x)) for x in forms):
            return True
    return False


_CLOSED_BY = {"(": ")", "（": "）", "[": "]", "{": "}", "“": "”", "«": "»", "「": "」", "『": "』", "《": "》"}
_CLOSERS = {v: k for k, v in _CLOSED_BY.items()}
_BRACKETS = frozenset("(（[{")
_delimiter = re.compile("[" + re.escape("".join([*_CLOSED_BY, *_CLOSERS])) + "]")


def _open_delimiters(text: str) -> list[int]:
    """Places of the delimiters that nothing closes, by a stack over the whole text; a closing one without its opener is passed over."""
    stack: list[int] = []
    for m in _delimiter.finditer(text):
        c = m.group()
        if c in _CLOSED_BY:
            stack.append(m.start())
        else:
            # what was opened within and left open does not outlive the pair around it
            for k in range(len(stack) - 1, -1, -1):
                # brackets of different kinds close each other, as in carelessly set text
                if text[stack[k]] == _CLOSERS[c] or (_CLOSERS[c] in _BRACKETS and text[stack[k]] in _BRACKETS):
                    del stack[k]
                    break
    return stack


def _empty_item(text: str) -> bool:
    """The text ends with the mark of a list item and nothing after it: the number after that of an item before, or a bullet like one before."""
    *others, last = [m for m in _item.finditer(text)] or [None]
    if last is None or last.end() < len(text):
        return False
    return any(int(m[1]) + 1 == int(last[1]) if m[1] and last[1] else m.group().strip() == last.group().strip() for m in others)


def _breaks_off(text: str, kept: str) -> bool:
    """An open delimiter or code fence, an unfinished JSON object or list item, or an ending in mid-sentence.

    A delimiter before the first word may be a mark of the layout and is passed
    over if the answer ends as a sentence. Bare labels (``name: value`` in one
    short line), lines of ``field: value`` and answers of up to three words need
    no closing mark.
    """
    if _json.match(text):
        try:
            json.loads(text)
            return False
        except ValueError:
            return bool(_open_delimiters(_json_string.sub("", text))) or text[-1] not in "]}"
    if _dangling.search(text) or text.count("```") % 2 or _empty_item(text):
        return bool(kept)
    ended = bool(_closed.search(text))
    first = next((i for i, c in enumerate(text) if c.isalnum()), len(text))
    if any(i > first for i in _open_delimiters(text)) or (not ended and _open_delimiters(text)):
        return bool(kept)
    if ended or len(text.split(None, 3)) <= 3 or _label.match(text):
        return False
    lines = [x for x in text.splitlines() if x.strip()]
    return not (len(lines) >= 2 and all(_field.match(x) for x in lines))


def pair_defects(instruction: str | None, context: str | None, answer: str | None) -> list[str]:
    """Every defect of a pair in rule order; an empty answer has no further defect. Text counts in composed form, whatever its length."""
    i, c, a = (unicodedata.normalize("NFC", x) if x and not x.isascii() else x or "" for x in (instruction, context, answer))
    said = plain_words(a)
    kept = said.replace(" ", "")
    if not kept or kept in _PLACEHOLDERS:
        return ["empty"]
    found = []
    if _refuses(a, said, c):
        found.append("refusal")
    iw, cw = plain_words(i), plain_words(c)
    ik, ck = iw.replace(" ", ""), cw.replace(" ", "")
    if _copies(a, kept, [ik, ck, ik + ck, ck + ik]):
        found.append("copied")
    text = a.strip()
    if _breaks_off(text, kept):
        found.append("truncated")
    bare = len(text.split(None, 3)) <= 3 and text[-1:] not in ".!?\u3002\uff01\uff1f"
    if not bare and (asked := language(iw + cw)):
        given = language(said)
        if given and given != asked and not _asked.search(i.lower()):
            found.append("other_language")
    return found


_PLACEHOLDERS = frozenset(PLACEHOLDERS)


def find_pair_defects(df: DataFrame, instruction: str = "instruction", context: str = "input", answer: str = "output") -> DataFrame:
    """Adds ``defects``, every defect type that fires in rule order, and ``defect``, the first or null.

    A null instruction or input counts as empty text. A null answer is
    ``empty``; an empty answer has no further defect. Any table with the three
    columns will do, and other columns are passed through untouched (columns
    already named ``defects`` or ``defect`` are replaced). No shuffle.
    """

    @F.pandas_udf("array<string>")
    def judged(i: pd.Series, c: pd.Series, a: pd.Series) -> pd.Series:
        return pd.Series([pair_defects(x, y, z) for x, y, z in zip(i, c, a)], index=a.index, dtype=object)

    found = df.withColumn("defects", judged(*[F.col(x).cast("string") for x in (instruction, context, answer)]))
    return found.withColumn("defect", F.get("defects", F.lit(0)))
