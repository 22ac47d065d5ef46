import re

from tidemark.llm import surrogates

from .awkward import TEXTS, awkward, empty

ROWS = [
    (1, 'Write to Ann.Lee7@mail.example.com, or call +1 (555) 010-2345 from 10.20.30.40. key = "0123456789abcdef0123456789abcdef01234567"'),
    (2, "ann.lee7@MAIL.example.com paid with 4111 1111 1111 1111 and 4111-1111-1111-1112; id 123-45-6789"),
    (3, "Mrs. Anna Smith met Mr Paul Smith. Mr Smith left; Ms ANNA stayed. Господин Пушкин и Госпожа Анна Пушкин."),
    (4, "version 1.2.3, price 23904, 3.14, a@b, 12-12-2020, Mr. x, 1234567890123456789012345 mails@"),
    (5, "(555) 010-2345 then +1 (555) 010-2345 and 1.2.3.4.5"),
    (6, None),
    (7, ""),
]


def replaced(spark, rows=ROWS, key="k"):
    return {r.doc_id: r for r in surrogates.replace(awkward(spark, rows), key).select("doc_id", "text", "n_mentions").collect()}


def test_types_forms_and_coreference(spark):
    got = replaced(spark)
    one, two, three = (got[k].text for k in (1, 2, 3))
    mail = re.search(r"[\w.]+@[\w.]+", one)[0]
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@example\.\w+", mail) and mail in two
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} from \d+\.\d+\.\d+\.\d+\. key = \"[0-9a-f]{40}\"$", one)
    cards = re.search(r"with (\d{4}( \d{4}){3}) and (\d{4}(-\d{4}){3}); id (\d{3}-\d{2}-\d{4})$", two)
    assert cards and cards[1].replace(" ", "") != cards[3].replace("-", "")
    for part in ("Lee7", "555", "10.20", "0123456789abcdef", "1111", "45-6789", "Anna", "ANNA", "Paul", "Smith", "Пушкин", "Анна"):
        assert part not in one + two + three
    assert [got[k].n_mentions for k in range(1, 8)] == [4, 4, 6, 0, 2, 0, 0]
    names = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr (\w+) (\w+)\. Mr (\w+) left; Ms (\w+) stayed\. Господин (\w+) и Госпожа (\w+) (\w+)\.", three)
    anna, s1, paul, s2, s3, loud, p1, an, p2 = names.groups()
    assert s1 == s2 == s3 and p1 == p2 and anna.endswith("la") and paul.endswith("n") and loud.isupper()
    assert all("а" <= c <= "я" or c in "ёЁ" or c.isupper() for c in p1 + an)


def test_texts_without_mentions_stay(spark):
    got = replaced(spark)
    assert got[4].text == ROWS[3][1] and got[6].text is None and got[7].text == ""


def test_the_key_decides(spark):
    assert replaced(spark)[1].text == replaced(spark)[1].text != replaced(spark, key="other")[1].text


def test_distinct_values_stay_distinct(spark):
    # two-letter names have few surrogates, so some must clash and be hashed anew
    rows = [(k, f"{chr(97 + k // 26)}{chr(97 + k % 26)}@x.org") for k in range(400)]
    got = [r.text for r in replaced(spark, rows).values()]
    assert len(set(got)) == 400 and not set(got) & {t for _, t in rows}


def test_forms_of_few_values(spark):
    blank, short = "-" * 40, [f"{'_' * 34}{k}" for k in range(10)]
    rows = [(0, f'"{blank}"'), *((k + 1, f"'{s}'") for k, s in enumerate(short))]
    found = replaced(spark, rows[:3])
    assert found[0].text == rows[0][1] and found[0].n_mentions == 0 and found[1].n_mentions == 1
    # ten secrets of one digit have no ten surrogates of their form; cards and addresses are lengthened alike
    values = [("secret", s, "") for s in short] + [("card", str(k), "") for k in range(10)] + [("ip", "1.2.3.4", "")]
    frame = spark.createDataFrame(values, "kind string, value string, script string")
    table = surrogates.surrogate_table(frame, "k", attempts=2).collect()
    new = [(r.kind, r.surrogate) for r in table]
    assert len(set(new)) == 21 and not set(new) & {v[:2] for v in values}


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = surrogates.replace(docs, "k")
    assert sorted(map(str, (r.text for r in found.collect()))) == sorted(map(str, (t for _, t in TEXTS)))
    assert surrogates.replace(empty(spark), "k").count() == 0
    twice = awkward(spark, [(1, "call +1 (555) 010-2345"), (1, "call +1 (555) 010-2345")])
    assert len({r.text for r in surrogates.replace(twice, "k").collect()}) == 1


def test_no_python_in_the_plan(spark):
    plan = surrogates.replace(awkward(spark, ROWS), "k")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
