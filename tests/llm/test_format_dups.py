import json
import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpusgate.llm.format_dups import canonical_fields, collapse_formatting, formatting_copies


def brute(rows):
    groups = {}
    for no, t in rows:
        k = "".join(c for c in (t or "").lower() if c.isalnum())
        if k and no is not None:
            groups.setdefault(k, []).append(no)
    return sorted((min(g), n) for g in groups.values() for n in sorted(g)[1:]), sorted((min(g), len(g)) for g in groups.values())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.sampled_from(["Kho số 1", "kho  SỐ-1.", "kho số\n1", "kho số 12", " ", "", "...", "½ Đất", "½ đất!", "Kho số 1"])), max_size=25))
def test_against_brute_force(spark, texts):
    rows = list(enumerate(texts)) + [(None, "Kho số 1")]
    df = spark.createDataFrame(rows, "no long, text string").withColumnsRenamed({})
    copies, groups = brute(rows)
    assert sorted(map(tuple, formatting_copies(df, "no", ["text"]).collect())) == copies
    assert sorted((r.first_no, r.copies) for r in collapse_formatting(df, "no", ["text"]).collect()) == groups


def test_field_order_does_not_count_but_fields_keep_their_values(spark):
    pairs = {"don_vi": "kho lưu trữ", "han": "3 ngày", "nhom": "a"}
    turned = dict(reversed(pairs.items()))
    lines = lambda d, sep=": ": "\n".join(f"{k}{sep}{v}" for k, v in d.items())
    same = [json.dumps(pairs, ensure_ascii=False), json.dumps(turned, ensure_ascii=False, indent=1), lines(pairs), lines(turned, ":").upper(), "- " + lines(turned).replace("\n", "\n- "), lines(pairs).replace("kho lưu", "kho\n  lưu")]
    other = [lines({"don_vi": "3 ngày", "han": "kho lưu trữ", "nhom": "a"}), lines({"don_vi": "kho lưu trữ", "han": "3 ngày"}), "Trả lời: kho lưu trữ 3 ngày"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(same + other)], "no long, t string")
    keys = {r.no: r.k for r in df.select("no", canonical_fields(df.t).alias("k")).collect()}
    assert len({keys[i] for i in range(len(same))}) == 1
    assert len({keys[i] for i in range(len(same + other))}) == 1 + len(other)


def test_hot_group_clashing_names_and_empty_table(spark):
    texts = ["Điều 1."] * 300 + [re.sub("1", f"1{'.' * (n % 40)}", "điều 1") for n in range(300)] + [f"khác {n}" for n in range(300)]
    df = spark.createDataFrame([(n, t, t) for n, t in enumerate(texts)], "first_no long, copies string, text string")
    got = formatting_copies(df, "first_no", ["text"]).collect()
    assert len(got) == 599 and {r.first_no for r in got} == {0}
    assert formatting_copies(df.limit(0), "first_no", ["text"]).count() == 0


def test_marks_count_and_composed_forms_agree(spark):
    d = lambda s: unicodedata.normalize("NFD", s)
    texts = ["किताब", "कतब", "má số", d("MÁ, số"), d("mà số"), "ma so", "ḿ"]
    df = spark.createDataFrame(list(enumerate(texts)), "no long, t string")
    assert sorted(map(tuple, formatting_copies(df, "no", ["t"]).collect())) == [(2, 3)]
    same = spark.createDataFrame([(0, "a: má\nb: hai"), (1, d("B: hai\nA: má"))], "no long, t string")
    assert formatting_copies(same, "no", [], ["t"]).count() == 1
