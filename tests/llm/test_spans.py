import hashlib
import itertools
import math
import random
import re

import public_tokenizers

from shelfcast.llm import pii_boost, secret_cost

WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, row_no long, kind int, added string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", 1, 2, "x") for d, t in rows], SCHEMA)


def plain_personal(text):
    """The base rules as written, by plain regular expressions."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        check = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and check % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def odd_texts(alphabet, n=4000):
    rng = random.Random(6)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_base_personal_spans_follow_the_rules():
    samples = ["a@b.c", "x@y@z.de,q@r.s.t.", "@a.b", "a.b@c", "é.a@b.co é1.2.3.4.5.6", "256.1.1.1 1.1.1.255 0001.0.0.0",
               "4111 1111 1111 1111", "4111-1111-1111-1112 4111111111111111", "+1 (386) 555-3733 +1", "++49 30 1234567.",
               "x" * 300 + "@" + "y.z" + "w" * 70 + "@v.u", "1.2.3." + "9" * 4000 + " 5"]
    for text in samples + odd_texts(list("a1.@+ -")) + odd_texts(list("12.5 -+(")):
        assert pii_boost.base_spans(text) == plain_personal(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "a" * 300_000 + "@b.c", "!" + "a" * 200_000 + "@b.c", "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, " " * 300_000):
        pii_boost.base_spans(text)
        pii_boost.candidates(text)
        secret_cost.scan(text, {})


def test_trees_add_what_looks_like_base_spans(spark):
    rng = random.Random(8)
    rows, late = [], []
    for i in range(900):
        number = f"{rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        if i % 3 == 0:
            rows.append((i, f"please call +1 ({number} today"))
        elif i % 3 == 1:
            rows.append((i, f"item {rng.randint(100, 999)} {rng.randint(1000, 9999)} {rng.randint(100, 999)} of stock"))
        else:
            rows.append((i, "nothing of note"))
    late = [(5000, "phone (212) 555-0100 or mail jane at example dot com"), (5001, None), (5002, ""), (None, "x@y.zz"), (5003, "x@y.zz"), (5003, "x@y.zz")]
    got = {r.doc_id: r for r in pii_boost.personal_spans(frame(spark, rows + late)).collect()}
    for i, text in rows:
        base = plain_personal(text)
        assert got[i].base_sha256 == hashlib.sha256(pii_boost.spelled(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii_boost.KINDS] == [sum(b[0] == j for b in base) for j in range(4)]
        assert set(pii_boost.spelled(base).split(",")) <= set(got[i].spans.split(","))
        assert i % 3 == 0 or got[i].n_added == 0  # clean documents stay clean
    assert got[5001].spans == got[5002].spans == "" and got[None].spans == "email:0:6"


def personal_corpus(rng):
    rows = []
    for i in range(1500):
        name, host = rng.choice(["jane", "bob.k", "maria", "li"]), rng.choice(["example", "mail-x", "shop"])
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, [f"please mail {name}@{host}.com today", f"call phone +1 {number} now", "nothing of note",
                         f"we met at noon. Then {name} left (dot) by", f"item {rng.randint(100, 999)} {rng.randint(1000, 9999)} {rng.randint(100, 999)} of stock"][i % 5]))
    return rows


def test_spelled_addresses_and_plain_phones_are_added(spark):
    late = [(5000, "phone (212) 555-0100 or mail jane at example dot com")]
    got = {r.doc_id: r for r in pii_boost.personal_spans(frame(spark, personal_corpus(random.Random(3)) + late)).collect()}
    assert got[5000].spans == "email:29:52,phone:6:20" and got[5000].n_added == 2
    assert all(got[i].n_added == 0 for i in range(1500))


def test_a_hot_source_switches_no_kind_off(spark, monkeypatch):
    monkeypatch.setattr(pii_boost, "SAMPLE", 1600)
    rng = random.Random(5)
    hot = [(10_000 + i, " ; ".join(f"row {rng.randint(100, 999)} {rng.randint(10**6, 10**7)} {rng.randint(10**5, 10**6)}" for _ in range(60))) for i in range(800)]
    model, limits = pii_boost.fit(pii_boost.proposed_spans(frame(spark, personal_corpus(rng) + hot)))
    assert {0, 3} <= set(limits)


def test_trees_learn_from_format_and_context(spark):
    rng = random.Random(8)
    rows = [(i, f"call tel +{rng.randint(1, 99)} 555 {rng.randint(100, 999)} {rng.randint(1000, 9999)} now" if i % 2 else
             f"rows {rng.randint(10, 99)}/{rng.randint(1000, 9999)}/{rng.randint(100, 999)}x") for i in range(600)]
    rows += [(10_000 + i, f"stock {rng.randint(10, 99)} / {rng.randint(1000, 9999)}-{rng.randint(100, 999)} left") for i in range(200)]
    found = pii_boost.proposed_spans(frame(spark, rows))
    model, limits = pii_boost.fit(found)
    assert 3 in limits and 0.5 <= limits[3] <= 1


def test_personal_spans_of_nothing(spark):
    assert pii_boost.personal_spans(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_secrets(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(out)


def test_base_secrets_follow_the_rules():
    samples = ["password=abcdefghijkl", "PassWord : 'abcdefghijkl'", "token token = \"0123456789abcdef01\"", "api_key=short",
               "secret==abcdefghijklm", "AKIA" + "A" * 14, "AKIA" + "A" * 13, "AKIAAKIA" * 4, "f" * 16, "f" * 15 + "g" + "0" * 17,
               "\u017fecret=abcdefghijklmnop", "to\u212aen=abcdefghijklmnop", "apikey = abc/def+ghi=jkl-é"]
    rng = random.Random(3)
    pieces = ["password", "TOKEN", "=", ":", " ", '"', "abcdef0123456789", "AKIA", "XYZ", "g", "api_key", "-", "é"]
    for text in samples + ["".join(rng.choice(pieces) for _ in range(9)) for _ in range(4000)]:
        assert secret_cost._base(text) == plain_secrets(text), text


def test_cost_is_the_cheapest_segmentation():
    ranks = {"word": 10, "cat": 3, "password": 1}

    def pieces(value):
        """Every segmentation into words and brute-force runs."""
        n, best = len(value), math.inf
        for cuts in itertools.product((0, 1), repeat=n - 1):
            edge = [0, *[i + 1 for i, c in enumerate(cuts) if c], n]
            cost = 0.0
            for a, b in zip(edge, edge[1:]):
                brute = sum(map(secret_cost._alphabet, value[a:b]))
                word = 0.3 + math.log10(ranks[value[a:b]] + 1) if value[a:b] in ranks else math.inf
                cost += min(brute, word)
            best = min(best, cost)
        return best

    for value in ("wordcat", "zcatq", "catword", "xkqv", "wordzzword"[:9]):
        assert secret_cost.guess_cost(value, ranks) <= pieces(value) + 1e-9
    for value in ("wordcat", "zcatq", "catword"):
        assert math.isclose(secret_cost.guess_cost(value, ranks), pieces(value), rel_tol=1e-9)


def test_patterns_are_cheaper_than_noise():
    ranks = secret_cost.word_ranks(WORDS)
    cost = lambda v: secret_cost.guess_cost(v, ranks)
    noise = cost("x9Kq2vT7bLw4")
    for weak in ("password2019", "qwertyuiop12", "aaaaaaaaaaaa", "abcabcabcabc", "2019-12-31ab", "SunshineDay1"):
        assert cost(weak) < noise - 3, weak
    assert noise > secret_cost.LEAST_COST and cost("") == 0
    assert math.isfinite(cost("k3" * 20000 + "Zz"))


def test_values_in_context_are_added(spark):
    rows = [(1, "pwd: x9Kq2vT7bLw4 end"), (2, "the password is sunshine today"), (3, "password=abcdef0123456789ab"),
            (4, None), (5, ""), (6, "token = ordinary words"), (None, "bearer Zx81!kqP0_yy"), (7, "pwd = 12345678"),
            (1, "pwd: x9Kq2vT7bLw4 end")]
    got = secret_cost.secret_spans(frame(spark, rows), WORDS).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].spans == "cost:5:17" and by[1].n_assign == 0
    assert by[2].n_added == by[6].n_added == by[7].n_added == 0
    assert by[3].spans == "assign:0:27,hex:9:27" and by[3].n_assign == by[3].n_hex == 1
    assert by[4].spans == by[5].spans == "" and by[5].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].spans == "cost:7:19"
    assert secret_cost.secret_spans(spark.createDataFrame([], SCHEMA), WORDS).count() == 0


def test_values_of_one_kind_of_characters_are_priced():
    ranks = secret_cost.word_ranks(WORDS)
    for text, span in (("pwd: kqzvwxjhtrplmnb", (5, 3, 20)), ("credential: 83920571640293", (12, 3, 26))):
        base, added, highest = secret_cost.scan(text, ranks)
        assert (base, added) == ([], [span]) and highest >= secret_cost.LEAST_COST
    for text in ("the password is Zusammenarbeit", "pwd: 12345678901234", "pwd: responsabilidad", "token: --------------", "secret is 20191231"):
        _, added, highest = secret_cost.scan(text, ranks)
        assert added == [] and highest is not None
