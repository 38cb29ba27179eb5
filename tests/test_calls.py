import re

from callsift.operators import calls as ops
from callsift.plans import jobs

BLOBS = [
    "hello\nAgent: hi\nthere\nCaller - my card is lost\nAGENT: ok",
    "Agent:\nCustomer: swallowed prefix",
    "see Agent: in mid-line",
    "no prefix at all",
    "Representative: a\n\n  member: b\nsupport - c",
    "customer: only",
    "User : x\nclient-y",
    "",
]


def split_blob(t):
    pattern = re.compile(r"(?:^|\n)\s*(" + "|".join(
        ["agent", "rep", "representative", "advisor", "associate", "operator", "support", "specialist", "staff",
         "csr", "customer", "user", "caller", "client", "member"]) + r")\s*[:\-]\s*", re.I)
    marks = list(pattern.finditer(t))
    sides = {True: [], False: []}
    for n, m in enumerate(marks):
        end = marks[n + 1].start() if n + 1 < len(marks) else len(t)
        customer = m.group(1).lower() in ("customer", "user", "caller", "client", "member")
        sides[customer].append(t[m.end():end].strip())
    return tuple("\n".join(sides[side]).strip() for side in (True, False))


def test_resegment(spark):
    df = spark.createDataFrame(list(enumerate(BLOBS)), "i int, t string")
    got = df.select("i", ops.resegment_by_prefix("t").alias("s")).orderBy("i").collect()
    assert [(r.s.customer_text, r.s.agent_text) for r in got] == [split_blob(t) for t in BLOBS]


def test_refine(spark):
    rows = [
        ("z", 0, "a", None, "Agent: hi\nCaller: my card"),
        ("z", 1, "b", " my loan ", "x"),
        ("z", 2, "c", None, "card and router"),
        ("z", 3, "d", "hello", "my card"),
        ("z", 4, "e", "", ""),
        ("z", 5, "f", None, "wi-fi bank"),
    ]
    df = spark.createDataFrame(rows, "source_zip string, ord long, file_name string, customer_text string, full_text string")
    got = {r.ord: (r.customer_text, r.full_text) for r in jobs.refine_subset(df).collect()}
    assert got == {0: ("my card", "Agent: hi\nCaller: my card"), 1: ("my loan", "x")}


def test_build_subset_filters_before_dedup(spark):
    def turns(*ts):
        return [(n, s, t) for n, (s, t) in enumerate(ts)]

    rows = [
        ("a", 0, "0", None, None, turns(("agent", "bank"), ("customer", "hello"))),
        ("a", 1, "1", None, None, turns(("customer", "my card"), ("agent", "ok"), ("robot", "beep"))),
        ("b", 0, "2", None, None, turns(("Customer", "my card"))),
        ("b", 1, "3", None, None, turns(("robot", "the bank"))),
        ("b", 2, "4", None, None, []),
    ]
    df = spark.createDataFrame(rows, "source_zip string, ord long, file_name string, domain string, topic string, turns array<struct<pos:bigint,speaker:string,text:string>>")
    got = {r.file_name: r for r in jobs.build_subset(df).collect()}
    assert set(got) == {"1", "3"}
    assert (got["1"].n_turns, got["1"].n_customer_turns, got["1"].agent_text) == (3, 1, "ok")
    assert got["1"].full_text == "my card\nok\nbeep"
    counters = jobs.subset_counters(df).first()
    assert (counters.checked, counters.matched, counters.kept) == (5, 3, 2)


def test_hot_copies_keep_the_first_call(spark):
    rows = [(f"z{n % 5}", n, None, "my card" if n % 3 else f"card {n}") for n in range(600)]
    df = spark.createDataFrame(rows, "source_zip string, ord long, customer_text string, full_text string").repartition(9)
    got = ops.first_by_hash(ops.keyword_calls(df))
    assert got.count() == 201
    first = got.where("full_text = 'my card'").first()
    assert (first.source_zip, first.ord) == ("z0", 5)
