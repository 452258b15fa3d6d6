"""Secrets: base patterns against brute force, assignments against planted ones, the registered query over its table."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from silverline.llm import secret_scan
from silverline.llm.queries import QUERIES


def brute_force(text):
    """The base spans as the contract words them, with cases spelt out instead of a flag."""
    any_case = lambda word: "".join(f"[{c}{c.upper()}]" for c in word)
    words = "|".join([*map(any_case, ("password", "passwd", "secret", "token")), any_case("api") + "_?" + any_case("key")])
    assign = rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m.group(2)) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(spans)]


def test_base_spans_match_brute_force():
    draw = random.Random(5)
    parts = ["password", "PassWD", "Secret", "toKen", "token", "api_key", "APIKEY", "paſsword", "=", ":", '"', "'", " ", "  ", "\n",
             "AKIA", "AKIAABCDEFGHIJKLMN", "abc", "0123456789ab", "deadbeef", "é", "日", "abcdefghijkl", "XYZ0", "/", "-"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 25)))
        found = [(kind, a, b) for kind, a, b, *_ in secret_scan.find_secrets(text) if kind != "literal"]
        assert found == brute_force(text), text


SECRET = "Zk38fj!Q0aa"
FOUND = [
    'db_pwd = "{}"',
    'val = "{}"\nconnect(user="bob", pwd=val)',
    'pwd = val\nval = "{}"',
    'a = "{}"\nb = a\nc = b\nclient_secret = c',
    'const char *PASS[] = "{}";',
    'char dbPassword[32] = "{}";',
    '{{"clientSecret": "{}", "name": "bob"}}',
    '{{"auth_token" => \'{}\'}}',
    'cfg["private_key"] = "{}"',
    "DB_PASS={}\nDB_HOST=localhost",
    "db:\n  passphrase: {}\n  user: bob",
    "<password>{}</password>",
    '<add key="DbPassword" value="{}"/>',
    "- name: DB_PASSWORD\n  value: {}",
    "run --password {} --user bob",
    "postgres://bob:{}@host/db",
    'os.environ.get("API_SECRET", "{}")',
    'settings.setPassword("{}");',
    'let pwd: String = "{}";',
    'secret := `{}`',
    "$pw = '{}';",
    'default_value = "{}"\npassword: ${{default_value}}',
    'password = decode("{}")',
]


@pytest.mark.parametrize("text", FOUND)
def test_literals_of_sensitive_targets(text):
    before, after = "Prose before it's over. é日\n", "\nand prose that's after, the key thing.\n"
    whole = before + text.format(SECRET) + after
    found = [whole[a:b] for kind, a, b, *_ in secret_scan.find_secrets(whole) if kind == "literal"]
    assert found == [SECRET]


def test_joined_literals_are_each_reported():
    text = 'private_key = "MIIEv9x" + part\npart = "QIBAD!ANBgk"'
    assert [text[a:b] for _, a, b, *_ in secret_scan.find_secrets(text)] == ["MIIEv9x", "QIBAD!ANBgk"]


CLEAN = [
    "The password: please enter your password here. It's the key thing, don't share your token, ok.",
    'password_file = "/etc/app/Pw9x.txt"',
    'password = "changeme"',
    'token = "your-token"',
    'password = "${DB_PASS}"',
    "password = password",
    "a = a + a\ntoken = a",
    "token = b\nb = token",
    "password: <enter it>",
    'public_key = "ssh-rsa AAAAB3Nza9x"',
    'primary_key = "doc_Id_1234x"',
    'password_hint = "Zk38fj!Q0aa"',
    'keyboard = "Zk38fj!Q0aa"',
    'name = "Zk38fj!Q0aa"',
    'secret = ""',
    "password == val && token != 'Zk38fj!Q0aa'",
    "secret: the meeting is at noon",
    'api_token = f"{prefix}abc"',
    "https://example.com/a?b=c",
    "monkey: bananas12 and turkey: Feathers34",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts(text):
    assert secret_scan.find_secrets(text) == []


def test_literals_within_base_spans_are_theirs():
    text = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'
    assert [s[0] for s in secret_scan.find_secrets(text)] == ["assign", "hex"]


def test_the_threshold_is_a_parameter():
    text = f'db_pwd = "{SECRET}"'
    (found,) = secret_scan.find_secrets(text)
    assert found[3] == "db_pwd" and secret_scan.find_secrets(text, threshold=found[4]) == [found]
    assert secret_scan.find_secrets(text, threshold=found[4] + 0.1) == []


def test_odd_rows(spark, docs, none):
    long = "x = y; it's " * 20_000 + f'pwd = "{SECRET}" ' + "( [ { ' \" " * 20_000
    more = spark.createDataFrame([(20, long, "en", "a", 1), (21, f'pwd = "{SECRET}"', None, None, None)], docs.schema)
    every = docs.unionByName(more).unionByName(more)
    clash = every.withColumns({"secrets": F.lit("old"), "kind": F.lit("mine"), "_text": F.lit(1)})
    rows = secret_scan.scan_secrets(clash).collect()
    assert len(rows) == every.count() and {r["kind"] for r in rows} == {"mine"}
    for row in rows:
        found = [row["text"][s["start"] : s["end"]] for s in row["secrets"]]
        assert found == ([SECRET] if row["doc_id"] in (20, 21) else [])
    assert secret_scan.scan_secrets(none).collect() == []


def test_registered_query_matches_brute_force(spark, tables):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = QUERIES["op13_secret_scan"](spark, tables).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts) and any(r["spans"] for r in rows)
    for row in rows:
        base = brute_force(texts[row["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
        spans = row["spans"].split(",") if row["spans"] else []
        assert [s for s in spans if not s.startswith("literal")] == (joined.split(",") if joined else [])
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
