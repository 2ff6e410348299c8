"""Operator 3."""

import re

import pytest
from pyspark.sql import functions as F

from skewsafe.llm import pii
from skewsafe.llm.common import table
from tests.conftest import SF_MID

from .helpers import ODD_TEXTS, docs, no_docs


def replaced(spark, texts, key="k"):
    out = pii.with_surrogates(docs(spark, texts), key).collect()
    return [r["text"] for r in sorted(out, key=lambda r: r["doc_id"])]


def luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_types_formats_and_coreference(spark):
    text = (
        "Mail Ann.Lee@corp.example.org or ann.lee@corp.example.org; call +1 (437) 555-0689 or 437-555-0689. "
        "Card 4111 1111 1111 1111 and 4111111111111111, host 10.1.2.3 and 8.8.4.4, ssn 078-05-1120, "
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962".'
    )
    out = replaced(spark, [text])[0]
    mails = re.findall(r"[\w.]+@[\w.]+", out)
    assert len(set(mails)) == 1 and mails[0].endswith(".example.org") and "lee" not in mails[0]
    phones = re.search(r"call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3}-\d{3}-\d{4})\.", out)
    assert phones and "-".join(phones.groups()[:3]) == phones[4] != "437-555-0689"
    cards = re.search(r"Card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}),", out)
    assert cards and cards[1].replace(" ", "") == cards[2] != "4111111111111111" and luhn(cards[2]) and cards[2][0] == "4"
    hosts = re.search(r"host (10\.\d+\.\d+\.\d+) and (\d+\.\d+\.\d+\.\d+),", out)
    assert hosts and hosts[1] != "10.1.2.3" and hosts[2] != "8.8.4.4"
    assert re.search(r"ssn \d{3}-\d{2}-\d{4},", out) and "078-05-1120" not in out
    assert re.search(r'token = "[0-9a-f]{40}"\.$', out) and "04dbebab" not in out


def test_names_keep_gender_script_and_title(spark):
    texts = ["Mr. John Smith met Mrs Jane Smith and Dr. Smith.", "Господин Иван Петров", "Κυρία Ελένη Παππά", "Frau Müller"]
    out = replaced(spark, texts)
    first = re.fullmatch(r"Mr\. (\S+) (\S+) met Mrs (\S+) (\S+) and Dr\. (\S+)\.", out[0])
    assert first and first[2] == first[4] == first[5] != "Smith"
    assert first[1].split("-")[0] in pii.GIVEN["latin", "m"] and first[3].split("-")[0] in pii.GIVEN["latin", "f"]
    assert re.fullmatch(r"Господин [А-Яа-яё-]+ [А-Яа-яё]+", out[1]) and "Петров" not in out[1]
    assert re.fullmatch(r"Κυρία [\u0370-\u03ff\u1f00-\u1fff-]+ [\u0370-\u03ff\u1f00-\u1fff]+", out[2])
    assert re.fullmatch(r"Frau [A-Z][a-z]+", out[3]) and out[3] != "Frau Müller"


def test_nothing_is_left_of_long_or_unusual_entities(spark):
    jwt = "eyJhbGciOi." + "Ab3_" * 300 + ".c2lnbmF0dXJl"
    cases = [  # text, what must be gone, the shape of the result
        (f'token = "{jwt}" end', [jwt[:40], jwt[-40:]], r'token = "[\w.]{%d}" end' % len(jwt)),
        ('API_KEY="abcdefgh1234"', ["abcdefgh1234"], r'API_KEY="[a-z]{8}\d{4}"'),
        ('{"token":"abcdefgh1234", "Password": "secret.word"}', ["abcdefgh1234", "secret.word"],
         r'\{"token":"[a-z]{8}\d{4}", "Password": "[a-z]{6}\.[a-z]{4}"\}'),
        ("Señora María José García López lives", ["María", "José", "García", "López"], r"Señora(?: \S+){4} lives"),
        ("Mr. John Q. Smith and Mr. John Q Smith left", ["John", "Q.", "Smith"],
         r"Mr\. (\S+) (\w(?:\.\w)*)\. (\S+) and Mr\. \1 \2 \3 left"),
        ("Dr. J.R. Smith. I know Dr. Jones2 or Mr. Ann Lee2", ["J.R.", "Smith", "Ann"],
         r"Dr\. (?:\w\.){2,} \S+\. I know Dr\. Jones2 or Mr\. \S+ Lee2"),
        ("Mr. " + "Abcd " * 3000 + "x", ["Abcd"], r"Mr\. (?:[\w-]+ ){3000}x"),
        ("Ms. Berg I Kn2 and Mr. K. B. Lind", ["Berg", "Lind"], r"Ms\. [A-Z]\w+ I Kn2 and Mr\. (?:\w\.)+ (?:\w\.)+ [A-Z]\w+"),
        ("call 555 123 4567 or 1 555 123 4567 or 555-123-4567", ["555 123", "123 4567", "123-4567"],
         r"call (\d{3}) (\d{3}) (\d{4}) or 1 \1 \2 \3 or \1-\2-\3"),
    ]
    for (text, gone, shape), out in zip(cases, replaced(spark, [text for text, _, _ in cases])):
        assert re.fullmatch(shape, out) and not any(g in out for g in gone), (text[:80], out[:200])


def test_more_initials_than_letters(spark):
    keys = [f"initials{pii._SEP}{a}" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"] + [f"initials{pii._SEP}A.{a}" for a in "BCD"]
    rows = pii.surrogates(spark.createDataFrame([(k,) for k in keys], "key string"), "k").collect()
    drawn = {r["surrogate"] for r in rows}
    assert len(rows) == len(drawn) == len(keys) and not drawn & {k.split(pii._SEP)[1] for k in keys}


@pytest.mark.parametrize(
    "text",
    ["4111111111111112", "300.1.2.3", "1.2.3.4.5", "04dbe4111111111111111", "a 123 b 2024-01-02", "mrs smith", "@home", "v1.2.3", "x@y"],
)
def test_what_fails_its_check_stays(spark, text):
    assert replaced(spark, [text]) == [text]


def test_odd_texts_and_repeats(spark):
    texts = [*ODD_TEXTS, "x a1b2c3@m.com y", "x a1b2c3@m.com y", "z" * 50_000 + "@" + "z" * 50_000]
    out = replaced(spark, texts)
    assert out[: len(ODD_TEXTS)] == ODD_TEXTS and out[-1] == texts[-1]
    assert out[-2] == out[-3] != texts[-2]
    assert replaced(spark, texts[-3:-1], "other key") != out[-3:-1]
    df = docs(spark, ["a@b.com"]).withColumnRenamed("lang", "_found").withColumnRenamed("source", "key")
    assert pii.with_surrogates(df, "k").columns == df.columns
    assert pii.with_surrogates(no_docs(spark), "k").count() == 0


def test_collisions_are_redrawn(spark):
    """More given names than the table holds: all surrogates differ, and none is a real name of the corpus."""
    keys = [f"given_m{pii._SEP}N{i}" for i in range(300)] + [f"given_f{pii._SEP}{n}" for n in pii.GIVEN["latin", "f"]]
    keys += [f"family{pii._SEP}F{i}" for i in range(3000)]
    rows = pii.surrogates(spark.createDataFrame([(k,) for k in keys * 2], "key string"), "k").collect()
    assert sorted(r["key"] for r in rows) == sorted(keys)
    for kind in ("given", "family"):
        mine = [r["surrogate"] for r in rows if r["key"].startswith(kind)]
        real = {k.split(pii._SEP)[1] for k in keys if k.startswith(kind)}
        assert len(set(mine)) == len(mine) and not real & set(mine)


def test_whole_table(spark):
    """Same rows and columns, consistent one-to-one replacement, nothing found is left."""
    before = table(spark, SF_MID, "documents")
    after = pii.with_surrogates(before, "k")
    assert after.columns == before.columns
    both = before.join(after.select("doc_id", F.col("text").alias("new"), F.col("lang").alias("l")), "doc_id").collect()
    assert len(both) == before.count() and all(r["lang"] == r["l"] for r in both)
    pattern = re.compile(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\w.])\d{16}(?!\w)|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w)")
    pairs = set()
    for r in both:
        old, new = pattern.findall(r["text"]), pattern.findall(r["new"])
        assert len(old) == len(new)
        pairs.update(zip(old, new))
    assert len(pairs) > 20
    assert len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
    assert all(a != b for a, b in pairs if not (a.isdigit() and not luhn(a)))


def test_plan_has_no_python(spark):
    plan = pii.with_surrogates(docs(spark, ["a@b.com"]), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("secret", ["********", "пароль-мой-дом", "κωδικόςμου", "😀😀😀😀😀😀😀😀", "########1", "密码密码密码密码", "пароль1пароль"])
def test_secrets_of_any_characters_are_replaced(spark, secret):
    """Masked, Cyrillic, Greek, Chinese and emoji secrets, several alike but for one character."""
    text = f'password = "{secret}" and token = "{secret}x"'
    [out] = replaced(spark, [text])
    found = re.fullmatch(r'password = "(.+)" and token = "(.+)"', out)
    assert found and found[1] != secret and found[2] != f"{secret}x" and found[1] != found[2]
    if re.search(r"[\u0400-\u04ff\u0370-\u03ff]", secret):
        assert secret[:3] not in out


def test_a_used_up_range_goes_on_elsewhere(spark):
    """Secrets of one digit beside fixed characters: more of them than digits."""
    secrets = [f"########{d}" for d in range(10)]
    out = replaced(spark, [f'token = "{s}"' for s in secrets])
    values = [re.fullmatch(r'token = "(.+)"', o)[1] for o in out]
    assert len(set(values)) == 10 and not set(values) & set(secrets)
