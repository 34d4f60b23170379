import email.utils
import random
from datetime import datetime, timedelta, timezone
from urllib.parse import parse_qs, urlencode, urlparse

from pyspark.sql import functions as F

from newsight import settings
from newsight.functions import dates, html, numeric, text, url


def test_canonical_url_golden(each):
    cases = {
        "http://Ex.com:80/p?b=1&a=&b=2&UTM_source=z&c=a%20b#f": "http://Ex.com:80/p?b=1&b=2&UTM_source=z&c=a+b",
        "http://a.com/x?": "http://a.com/x",
        "http://a.com/x?flag": "http://a.com/x",
        "http://a.com/x?a=1&b=2&a=3": "http://a.com/x?a=1&a=3&b=2",
        "HTTP://a.com/x?q=%zz": "http://a.com/x?q=%25zz",
        "http://[::1/x?utm_source=a#z": "http://[::1/x?utm_source=a#z",
        "http://a.com/x?utm_source=1&gclid=2#top": "http://a.com/x",
    }
    assert each(list(cases), url.canonical_url) == list(cases.values())


def test_canonical_url_agrees_with_standard_parsing(each):
    rng = random.Random(5)
    keys = ["a", "b", "ref", "utm_term", "é", "x y", "k~*"]
    urls = []
    for _ in range(300):
        pairs = [(rng.choice(keys), rng.choice(["1", "", "a b", "ü&=", "100%", "~*-_."])) for _ in range(rng.randint(0, 5))]
        urls.append("https://h.example/p/é?" + urlencode(pairs) + rng.choice(["", "#f"]))

    def expected(u):
        kept = {k: v for k, v in parse_qs(urlparse(u).query).items() if k not in settings.TRACKING_PARAMS}
        base = u.split("#")[0].split("?")[0]
        return base + ("?" + urlencode(kept, doseq=True) if kept else "")

    assert each(urls, url.canonical_url) == [expected(u) for u in urls]


def test_netloc(each):
    cases = {
        "http://a.com/é è?x=1": "a.com", "http://a_b.com/x": "a_b.com",
        "https://u:p@H.com:8080?x": "u:p@H.com:8080", "no scheme": "", "//h/x": "h",
    }
    assert each(list(cases), url.netloc) == list(cases.values())


def test_blocked_locale_redirect(each):
    assert each(["http://www.MSN.com/x", "http://a.com/msn.com"], url.is_blocked) == [True, False]
    assert each(["http://x.qc.ca/", "http://x.com/.qc.ca"], url.locale) == ["fr-CA", "en-US"]
    assert each(["https://news.google.com/a", "https://b.com"], url.is_redirect) == [True, False]


def test_parse_date_golden(each):
    cases = {
        "Mon, 17 Nov 2025 12:52:00 GMT": datetime(2025, 11, 17, 12, 52),
        "17 Nov 2025 12:52:00 -0500": datetime(2025, 11, 17, 17, 52),
        "17 Jul 2025 12:52:00 EST": datetime(2025, 7, 17, 17, 52),
        "2025-11-17T10:00:00-05:00": datetime(2025, 11, 17, 15),
        "2025-11-17T10:00:00.25Z": datetime(2025, 11, 17, 10, 0, 0, 250000),
        "2025-11-17T10:00:00": datetime(2025, 11, 17, 10),
        " 2025-11-17 ": datetime(2025, 11, 17),
        "2025-11-17 01:02:03": datetime(2025, 11, 17, 1, 2, 3),
        "11/17/2025, 07:00 AM, +0000 UTC": None,
        "2025-02-30": None, "": None, "soon": None,
    }
    assert each(list(cases), dates.parse_date) == list(cases.values())


def test_parse_date_reads_what_mail_libraries_write(each):
    rng = random.Random(3)
    moments = [
        datetime(rng.randint(1990, 2030), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23),
                 rng.randint(0, 59), rng.randint(0, 59),
                 tzinfo=timezone(timedelta(minutes=rng.choice([0, 60, -300, 330, -210]))))
        for _ in range(200)
    ]
    naive = [m.astimezone(timezone.utc).replace(tzinfo=None) for m in moments]
    assert each([email.utils.format_datetime(m) for m in moments], dates.parse_date) == naive
    assert each([m.isoformat() for m in moments], dates.parse_date) == naive


def test_relative_dates(each):
    now = datetime(2025, 11, 18)
    cases = {
        "2 hours ago": now - timedelta(hours=2), "Yesterday": now - timedelta(days=1),
        " 3 Weeks AGO, more": now - timedelta(weeks=3), "1 minute ago": now - timedelta(minutes=1),
        "just now": now, "Nov 17, 2025, 12:52 PM": datetime(2025, 11, 17, 12, 52),
        "november 7, 2025, 12:05:09 AM": datetime(2025, 11, 7, 0, 5, 9),
        "11/17/2025 1:02 pm": datetime(2025, 11, 17, 13, 2), "11/17/2025": datetime(2025, 11, 17),
        "17 Nov 2025": datetime(2025, 11, 17), "7 November 2025": datetime(2025, 11, 7),
        "Nov 17, 2025, 13:00 PM": None, "about 2 hours ago": None,
        "Mon, 17 Nov 2025 12:52:00 GMT": datetime(2025, 11, 17, 12, 52),
    }
    got = each(list(cases), lambda c: dates.parse_relative_date(c, "2025-11-18 00:00:00"))
    assert got == list(cases.values())


def test_round2_is_decimal_rounding_of_the_binary_value(spark):
    rng = random.Random(1)
    xs = [k / 200 for k in range(-400, 400)] + [rng.uniform(-3, 3) for _ in range(2000)] + [2.675, 0.125, 0.375]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", numeric.round2(F.col("x")).alias("r"))
    assert all(r.r == round(r.x, 2) for r in rows.collect())


def test_strip_and_blank(each):
    assert each(["  a \n", "\x1c　", None], text.strip) == ["a", "", None]
    assert each([" ", "x", None], text.is_blank) == [True, False, True]


def test_phrases(each):
    got = each(
        ["x" * 18 + ".", "a" * 350 + ". " + "b" * 19 + ".", "c" * 370, "d" * 351, None,
         "One two three four five six. Next one is here for you!"],
        text.phrases,
    )
    assert [[len(p) for p in r] for r in got] == [[], [350, 20], [350, 20], [350], [], [28, 25]]
    assert all(20 <= len(p) <= 350 for r in got for p in r)


def test_token_windows(each):
    sizes = [400, 401, 750, 751]
    got = each([" ".join(map(str, range(n))) for n in sizes], lambda c: text.token_windows(text.tokens(c)))
    assert [[int(w[0]) for w in r] for r in got] == [[0], [0, 350], [0, 350, 700], [0, 350, 700]]
    for n, r in zip(sizes, got, strict=True):
        assert {int(t) for w in r for t in w} == set(range(n))


def test_truncate_and_squeeze(each):
    assert each(["abcd", "abc"], lambda c: text.truncate(c, 3)) == ["abc...", "abc"]
    assert each(["né à l'été ✓✓!"], text.ascii_squeeze) == ["n    l' t   !"]


def test_page_text(each):
    page = (
        "<html><head><title>T</title><script>x<p>y</script></head><body><nav><a>menu</a></nav>"
        "<!-- hidden --><div class=\"ad\">buy</div><article><h1>Head</h1><p>A &amp; B&#233;&#xe9; &lt;3<br>next</p>"
        "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table></article>"
        "<div class=\"comments\">no</div><footer>f</footer></body></html>"
    )
    assert each([page, None], html.page_text) == ["Head\nA & Béé <3\nnext\na b\nc", None]


def test_parse_date_of_other_mail_orders(each):
    from datetime import datetime

    from newsight.functions.dates import parse_date

    at = datetime(2025, 1, 31, 10, 0)
    forms = {
        "Fri, 31 Jan 2025 10:00:00 +05:30": datetime(2025, 1, 31, 4, 30),
        "Fri, 31 Jan 2025 10:00:00 +0530": datetime(2025, 1, 31, 4, 30),
        "Fri, 31 Jan 2025 10:00:00 -05:00": datetime(2025, 1, 31, 15, 0),
        "Fri Jan 31 10:00:00 2025": at,
        "Fri, Jan 31 2025 10:00:00 GMT": at,
        "Fri, Jan 31, 2025 10:00:00 +0000": at,
        "Fri, 31 Jan 2025 10.00.00 GMT": at,
        "Fri, 31 Jan 2025 10:00:00 (noon) -0500": datetime(2025, 1, 31, 15, 0),
        "Fri, 31 Jan 2025 10:00:00 -0500 (EST)": datetime(2025, 1, 31, 15, 0),
        "2025-W05-5": None,
        "2025-01-31T10:00:00+00:00:30": None,
        "Smarch 31 10:00:00 2025": None,
    }
    assert dict(zip(forms, each(list(forms), parse_date))) == forms
