"""Quality rules, secrets, surrogates and languages against plain Python."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import pyarrow as pa
import pytest

from cases import ODD
from ledgerlens.llm import language, quality_rules, secret_scan, surrogates
from ledgerlens.session import shared_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_quality(text, n):
    words = WORD.findall(text or "")

    def covered(size):
        grams = collections.Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
        flags = [False] * len(words)
        for i in range(len(words) - size + 1):
            if grams[tuple(words[i:i + size])] > 1:
                flags[i:i + size] = [True] * size
        return sum(flags)

    longest = 0
    for size in range(n, len(words)):
        if not covered(size):
            break
        longest = size
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), covered(3), covered(n), longest)


def test_quality_figures_equal_plain_counting():
    rnd = random.Random(5)
    texts = [None, "", " \n ", "a", "# é|é\na b\na b"]
    for _ in range(150):
        base = [rnd.choice("abcdefgh") + rnd.choice("xyzé#") for _ in range(rnd.randrange(60))]
        cut = rnd.randrange(len(base) + 1)
        texts.append(" ".join(base + base[cut:cut + rnd.randrange(30)] + ["end"]) + "\n" + rnd.choice(["a b", "c"]))
    found = quality_rules.measure(pa.array([t or "" for t in texts]), quality_rules.Rules())
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
    for k, text in enumerate(texts):
        assert tuple(int(found[n][k]) for n in names) == plain_quality(text, 8), text


def test_quality_rejects_repetition_and_keeps_clean_text(make, odd, empty, clashing):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    clean = " ".join(word() for _ in range(300))
    passage = " ".join(word() for _ in range(120))
    rows = {r["doc_id"]: r for r in quality_rules.judge(make([(1, clean), (2, f"{passage} {passage}"), (3, "few")])).collect()}
    assert rows[1]["kept"] and not rows[2]["kept"] and rows[3]["base_failed"]
    assert quality_rules.judge(odd).count() == len(ODD)
    assert quality_rules.judge(empty).count() == 0
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns and kept.count() == 0


def plain_secrets(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text or "", re.ASCII):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secret_spans_equal_plain_search(make, odd, empty, clashing):
    rnd = random.Random(4)
    bits = ["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", " ", '"', "'", "abcdef", "AKIA",
            "ABCDEFGHIJKLMNOP12", "0123456789abcdef01234567", "é", "😀", "\n", "x.y/z"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(25))) for _ in range(300)] + [
        "token: token: abcdefgh", "AKIAAKIA" + "A" * 16]
    rows = {r["doc_id"]: r for r in secret_scan.scan(make(list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        expected = plain_secrets(text)
        assert rows[k]["base_sha256"] == hashlib.sha256(expected.encode()).hexdigest(), text
        assert set(filter(None, expected.split(","))) <= set(filter(None, rows[k]["spans"].split(",")))
    assert secret_scan.scan(odd).count() == len(ODD)
    assert secret_scan.scan(empty).count() == 0
    assert secret_scan.scan(clashing).count() == 3
    masked = secret_scan.without_secrets(clashing)
    assert masked.columns == clashing.columns and masked.where("_base = 'x' and _key = 'x'").count() == 3
    assert masked.where("doc_id = 1").first()["text"] == "a text with password=[SECRET] in it"


def test_owner_specific_values_are_added_and_masked_and_copied_ones_stay(make):
    live, copied = "q7Rt9ZkLm3Xv8Wn5Bd2Hf6Jp", "Ex4mpleEx4mpleEx4mpleEx4"
    rows = [(1, f"key is {live} here", "en", "a")] + [(k, f"use {copied} so", "en", f"s{k}") for k in range(2, 7)]
    docs = make(rows)
    found = {r["doc_id"]: r for r in secret_scan.scan(docs).collect()}
    assert found[1]["n_added"] == 1 and found[1]["spans"] == f"generic:7:{7 + len(live)}"
    assert all(found[k]["n_added"] == 0 for k in range(2, 7))
    masked = {r["doc_id"]: r["text"] for r in secret_scan.without_secrets(docs).collect()}
    assert masked[1] == "key is [SECRET] here" and masked[3] == f"use {copied} so"
    owners = {r["owners"] for r in secret_scan.report(docs).collect()}
    assert owners == {1, 5}


def test_a_template_of_one_hot_source_is_a_copied_example(make):
    """Owners alone do not tell: one source holds a third of all rows and repeats a value in each."""
    live, template = "q7Rt9ZkLm3Xv8Wn5Bd2Hf6Jp", "Ex4mpleEx4mpleEx4mpleEx4"
    rows = [(k, f"row {k} says {template}", "en", "hot") for k in range(100)]
    rows += [(1000 + k, f"row {k} says {live}", "en", "hot") for k in range(3)]
    rows += [(2000 + k, f"plain row {k}", "en", f"s{k}") for k in range(200)]
    found = {r["doc_id"]: r["n_added"] for r in secret_scan.scan(make(rows)).collect()}
    assert [found[k] for k in (0, 99, 1000, 1002, 2000)] == [0, 0, 1, 1, 0]
    masked = {r["doc_id"]: r["text"] for r in secret_scan.without_secrets(make(rows)).collect()}
    assert masked[5].endswith(template) and masked[1001].endswith("[SECRET]")
    figures = {(r["owners"], r["repositories"], r["copied_example"]) for r in secret_scan.report(make(rows)).collect()}
    assert figures == {(1, 100, True), (1, 3, False)}
    assert secret_scan.scan(make(rows), example_repositories=1000).where("n_added = 1").count() == 103


def test_full_name_spaces_get_longer_surrogates(spark, make):
    """All one-letter mailboxes of a provider, and a thousand one-digit addresses with most of their space real."""
    shared_folder(spark, "test")
    boxes = [f"{chr(97 + k)}@example.com" for k in range(26)]
    hosts = [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in (1, 2)]
    docs = make([(k, f"write to {v} now") for k, v in enumerate(boxes)] + [(100 + k, f"host {v} is up") for k, v in enumerate(hosts)])
    out = {r["doc_id"]: r["text"] for r in surrogates.replace(docs, "k1").collect()}
    made = [out[k].split()[2] for k in range(26)]
    assert len(set(made)) == 26 and not set(made) & set(boxes) and all("@" in m for m in made)
    made = [out[100 + k].split()[1] for k in range(len(hosts))]
    assert len(set(made)) == len(hosts) and not set(made) & set(hosts)
    assert all(len(m.split(".")) == 4 and all(0 < int(x) < 256 for x in m.split(".")) for m in made)


def test_surrogates_keep_format_coreference_and_distinctness(spark, make, odd, empty, clashing):
    shared_folder(spark, "test")
    rnd = random.Random(6)
    number = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    people = [f"u{number(3)}.x@mail{k}.example.com" for k in range(60)]
    cards = [f"4{number(15)}" for _ in range(60)]
    rows = [(k, f"Write {p} or {p.upper()}, pay {c}, from 10.2.33.{k} call +1 (203) 555-{1000 + k}. Herr Klaus Weber, "
                f"Mrs. Anna Weber. SSN 123-45-{6000 + k}") for k, (p, c) in enumerate(zip(people, cards))]
    docs = make(rows)
    out = {r["doc_id"]: r for r in surrogates.replace(docs, "k1").collect()}
    again = {r["doc_id"]: r["text"] for r in surrogates.replace(docs.repartition(5), "k1").collect()}
    assert again == {k: r["text"] for k, r in out.items()}
    shape = re.compile(r"Write (\S+@\S+?\.com) or (\S+@\S+?\.COM), pay (\d{16}), from (\d+\.\d+\.\d+\.\d+) call "
                       r"(\+1 \(\d{3}\) \d{3}-\d{4})\. Herr (\w+ \w+), Mrs\. (\w+ \w+)\. SSN (\d{3}-\d{2}-\d{4})$")
    seen = [set() for _ in range(8)]
    for k, r in out.items():
        m = shape.match(r["text"])
        assert m and r["n_entities"] == 8, r["text"]
        assert m[1].upper() == m[2]
        digits = [int(x) for x in reversed(m[3])]
        assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
        assert all(0 <= int(x) < 256 for x in m[4].split("."))
        assert not any(original in r["text"] for original in (people[k], cards[k], "Klaus", "Anna"))
        for place, value in enumerate(m.groups()):
            seen[place].add(value)
    assert [len(s) for s in seen] == [60, 60, 60, 60, 60, 1, 1, 60]
    assert surrogates.replace(odd, "k1").count() == len(ODD)
    assert surrogates.replace(empty, "k1").count() == 0
    assert surrogates.replace(clashing, "k1").where("n_entities > 0").count() == 1
    clean = {r["doc_id"]: r["text"] for r in surrogates.replace(make([(1, "version 2.0. of 42 things")]), "k").collect()}
    assert clean == {1: "version 2.0. of 42 things"}


def test_one_name_is_one_surrogate_with_or_without_any_form_of_address(spark, make):
    shared_folder(spark, "test")
    rows = [(1, "Dr Anna Bell met Mrs Anna Bell. Anna Bell and ANNA BELL left; Annabel stayed, Anna Bells too."),
            (2, "Prof. Anna Bell wrote."), (3, "Mrs. Anna Bell and Mr Tom Ray, then Tom Ray"), (4, "Anna Bell alone")]
    out = {r["doc_id"]: r for r in surrogates.replace(make(rows), "k1").collect()}
    m = re.match(r"Dr (\w+ \w+) met Mrs (\w+ \w+)\. (\w+ \w+) and (\w+ \w+) left; Annabel stayed, Anna Bells too\.$",
                 out[1]["text"])
    assert m and m[1] == m[2] == m[3] and m[4] == m[1].upper() and m[1].split()[0].endswith("a")
    assert out[1]["n_entities"] == 4 and out[1]["entities"].endswith("name:32:41,name:46:55")
    assert out[2]["text"] == f"Prof. {m[1]} wrote."
    tom = re.match(rf"Mrs\. {m[1]} and Mr (\w+ \w+), then (\w+ \w+)$", out[3]["text"])
    assert tom[1] == tom[2] and tom[1].split()[0].endswith("n")
    assert out[4]["text"] == "Anna Bell alone"


def test_checks_see_names_with_their_ending_and_domains(spark, monkeypatch):
    """A name and a domain that occur are not put out for others; where short domains are all taken, longer ones are."""
    from pyspark.sql import functions as F

    shared_folder(spark, "test")
    monkeypatch.setattr(surrogates, "LONGER", 1)

    def table(rows):
        return spark.createDataFrame(rows, "kind string, entity string, gender string").coalesce(1)

    def made(rows):
        columns = [F.col("kind"), F.col("entity"), F.lit(0), F.col("gender")]
        return [r[0] for r in rows.select(surrogates.canonical_surrogate("k", *columns)).collect()]

    name, domain = made(table([("name", "eva stone", "f"), ("domain", "mail.org", "")]))
    assert name.split()[0].endswith("a")
    short = [("email", f"someone@{c}.net", None) for c in "abcdefghijklmnopqrstuvwxyz"]
    taken = [("name", "eva stone", "f"), ("name", name, ""), ("email", "x@mail.org", None), ("email", f"y@{domain}", None)]
    changed = {(r["kind"], r["entity"]): r for r in surrogates.exceptions(table(taken + short), "k").collect()}
    assert changed["name", "eva stone"]["attempt"] > 0 and changed["domain", "mail.org"]["attempt"] > 0
    assert all(changed["domain", e.split("@")[1]]["attempt"] > 0 for _, e, _ in short)


def test_clashing_surrogates_are_drawn_again(spark, monkeypatch):
    """Octets of one digit leave few surrogates, so some must clash at first."""
    shared_folder(spark, "test")
    values = [(f"{a}.{b}.{c}.{d}",) for a in range(1, 9) for b in range(1, 9) for c in range(1, 9) for d in (1, 2)]
    entities = spark.createDataFrame(values, "entity string").selectExpr("'ip' as kind", "entity")
    from pyspark.sql import functions as F

    changed = surrogates.exceptions(entities, "k")
    assert changed is not None
    attempts = entities.join(changed, ["kind", "entity"], "left").withColumn(
        "made", surrogates.canonical_surrogate("k", F.col("kind"), F.col("entity"), F.coalesce("attempt", F.lit(0))))
    rows = attempts.collect()
    made = [r["made"] for r in rows]
    assert len(set(made)) == len(made) and not set(made) & {v[0] for v in values}


def test_language_by_held_out_accuracy(spark, make, odd, empty, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    from ledgerlens.llm.queries import op10_language, remainder

    found = op10_language(spark, folder).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.85 * len(found)
    fitted = language.fit(docs.where(remainder(5) != 0))
    rows = language.predict(odd, fitted).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    blank = language.predict(make([(1, None), (2, ""), (3, "123 !?"), (4, "the")]), fitted).collect()
    assert {r["doc_id"]: r["lang_pred"] == "und" for r in blank} == {1: True, 2: True, 3: True, 4: False}
    assert language.fit(empty) == {} and language.predict(empty, fitted).count() == 0
    assert {r["lang_pred"] for r in language.predict(odd, {}).collect()} == {"und"}
    with pytest.raises(ValueError):
        language.fit(docs, max_languages=2)


def test_language_sample_counts_distinct_texts_and_fills_its_bounds(make):
    """A language made mostly of copies, and one of few very long texts, are sampled up to the bound."""
    rnd = random.Random(8)
    texts = lambda letters, n, words: [" ".join("".join(rnd.choice(letters) for _ in range(6))
                                               for _ in range(words)) for _ in range(n)]
    few, copied, long = texts("abcdef", 25, 60), texts("ghijkl", 1, 60) * 3000, texts("mnopqr", 30, 15_000)
    rows = [(k, t, lang) for k, (t, lang) in enumerate(
        [(t, "copies") for t in copied + few] + [(t, "long") for t in long] + [("12 34 !", "none")])]
    docs = make(rows, 4)
    found = language.fit(docs)
    assert sorted(found) == ["copies", "long"]
    assert set(found["copies"].decode().split("\n")) == set(few + copied)
    assert len(found["long"]) == 96 << 10
    assert language.fit(docs.repartition(7), salts=3) == found
    small = language.fit(docs, texts_per_language=5, bytes_per_language=1 << 20)
    assert {len(v.split(b"\n")) for v in small.values()} == {5}
    test = make([(1, few[3]), (2, found["long"].decode()[5000:6000])])
    assert {r["doc_id"]: r["lang_pred"] for r in language.predict(test, found).collect()} == {1: "copies", 2: "long"}
