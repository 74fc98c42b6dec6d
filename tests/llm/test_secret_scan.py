import hashlib
import random
import re

from pathloom.llm.queries import op4_secrets
from pathloom.llm.secret_scan import MARK, literal_spans, redact_secrets, redacted, scan_secrets, spans


def plain_base(text):
    """The contract's patterns as they are written, without any shortcut."""
    word = "(" + "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) \
        + "|[aA][pP][iI]_?[kK][eE][yY])"
    assign = re.compile(word + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def row(doc_id, text):
    kinds = ("assign", "access", "hex", "literal")
    base = plain_base(text)
    joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in base)
    return (doc_id, *(sum(s[1] == k for s in base) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest())


def test_query_keeps_the_base(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = {r.doc_id: r for r in op4_secrets(spark, small).collect()}
    assert len(found) == len(docs)
    for doc_id, text in docs.items():
        assert tuple(found[doc_id])[:5] == row(doc_id, text)
        base = {f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in plain_base(text)}
        assert base <= set(found[doc_id].spans.split(",")) or not base


def test_random_texts_keep_the_base():
    rng = random.Random(1)
    words = ["password", "PassWD", "api_key", "ApiKey", "secret", "ſecret", "toKen", "=", ": ", '"', "'", " ", "AKIA", "ABCDEFGH12345678", "deadbeef01234567", "0123456789abcdef", "x", "\n", "é", "abc/+=-_.", "xyz"]
    for _ in range(3000):
        text = "".join(rng.choice(words) for _ in range(rng.randrange(1, 14)))
        assert [s for s in spans(text) if s[1] < 3] == plain_base(text), text


def held(text):
    return sorted(text[a:b] for a, _, b in literal_spans(text))


def test_lexing_and_propagation():
    assert held('db_password = "Tr0ub4dor&3x"') == ["Tr0ub4dor&3x"]
    assert held('k = "Zx81-Spectrum"\nother = k\nclient_secret: str = other') == ["Zx81-Spectrum"]
    assert held("part = 'aB3dE6gH9jK'\nauth_token = part + \"mN2pQ5sT8v\"") == ["aB3dE6gH9jK", "mN2pQ5sT8v"]
    assert held('{"credentials": {"privateKey": "q9W8e7R6t5Y4", "user": "q9W8e7R6t5Y5"}}') == ["q9W8e7R6t5Y4"]
    assert held("PWD: 'Abc123$xyz' # note\nexport SIGNING_KEY=aB3/dE6gH9jKlM0pQ==") == ["Abc123$xyz", "aB3/dE6gH9jKlM0pQ=="]
    assert held('a = b\nb = a\npassword = a') == []
    assert held('password = "changeme"; token = "<your token>"; secret = "${SECRET_1}"; max_tokens = "Qw3rty!uiop"') == []
    assert held("The secret: nothing here is one. A token of thanks = friendship, author: SomeBody1234") == []
    assert held("password = 'é1ß2漢3字4X5'") == ["é1ß2漢3字4X5"]


def test_long_inputs_stay_linear():
    for text in ("password=" * 60000, "a=" * 100000 + "token", "token:" + '"' * 100000, "secret " + "x" * 500000, "key='" + "\\" * 200001):
        assert isinstance(spans(text), list)


def test_nulls_repeats_and_redaction(spark):
    rows = [(1, None, 5, "a"), (None, "", 0, "b"), (2, "token: abcdef12 x", 17, "c"), (2, "token: abcdef12 x", 17, "c"), (3, "clean é text", None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    found = scan_secrets(docs).collect()
    assert [len(r.spans) for r in found] == [0, 0, 1, 1, 0]
    kept = sorted(map(tuple, redact_secrets(docs).collect()), key=repr)
    assert kept == sorted([(1, None, 5, "a"), (None, "", 0, "b"), *[(2, MARK + " x", len(MARK) + 2, "c")] * 2, (3, "clean é text", None, "d")], key=repr)
    assert redacted("0123456789", [(1, 0, 4), (3, 2, 6), (8, 1, 9)]) == f"0{MARK}67{MARK}9"
    assert scan_secrets(docs.limit(0)).collect() == [] and redact_secrets(docs.limit(0)).collect() == []


def test_whole_words_make_a_name_harmless():
    for name in ("adminPassword", "ADMIN_PWD", "account_secret", "accountCredential", "security_token", "authorization_token", "profile_secret", "namespace_token"):
        assert held(f"{name} = 'Abc123$xyz'") == ["Abc123$xyz"], name
        assert held(f"k = 'Zx81-Spectrum'\n{name} = k") == ["Zx81-Spectrum"], name
    for name in ("max_tokens", "maxTokens", "maxtokens", "tokenCount", "password_file", "secretName", "TOKEN_URL", "tokenizer", "token_expires", "passwordMinLength"):
        assert held(f"{name} = 'Abc123$xyz'") == [], name


def test_literals_that_only_begin_like_placeholders():
    for literal in ("$2b$12$abcdefghijkLMNOP", "%kT9x!qZ", "<kT9x!qZ", "{kT9x!qZ", "correct horse battery staple", "hunter22"):
        assert held(f"db_password = '{literal}'") == [literal], literal
    for literal in ("${DB_PASSWORD}", "{{ db.password }}", "%(password)s", "<your password>", "$DB_PASSWORD", "Please enter a password"):
        assert held(f"db_password = '{literal}'") == [], literal
    assert held("password_hint = 'at least one digit, please'") == []
