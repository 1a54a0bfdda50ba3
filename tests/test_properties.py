"""Properties over generated values."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from accessaudit.functions import after_last_equals, canonical_port, day_text
from accessaudit.operators.identity import ip_user_map
from accessaudit.operators.lookup import ShortList
from accessaudit.operators.membership import with_membership
from accessaudit.operators.results import dense_ids
from accessaudit.sources.records import resume_offsets
from tests.helpers import rows

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.one_of(st.none(), st.text(alphabet="ab=&%é 09", max_size=12))


@FEW
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_text_functions(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(after_last_equals("t"), day_text("t")).collect()
    assert [r[0] for r in got] == [None if t is None else t.rsplit("=", 1)[-1] for t in texts]
    assert [r[1] for r in got] == [None if t is None else t[:10] for t in texts]


@FEW
@given(st.lists(st.integers(0, 65535), min_size=1, max_size=30))
def test_ports_compare_as_numbers(spark, ports):
    df = spark.createDataFrame([(f"{p:07d}", str(p)) for p in ports], "padded string, plain string")
    assert df.where(canonical_port("padded") != canonical_port("plain")).isEmpty()


@FEW
@given(
    st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=20),
    st.sets(st.sampled_from(["a", "b", "z"])),
    st.booleans(),
)
def test_membership_is_sql_in(spark, items, known, with_null):
    df = spark.createDataFrame(list(enumerate(items)), "n int, v string")
    out = with_membership(df, "v", ShortList(tuple(sorted(known)), with_null), "f")
    for row in out.collect():
        if row["v"] is None:
            assert row["f"] is None
        elif row["v"] in known:
            assert row["f"] is True
        else:
            assert row["f"] is (None if with_null else False)


@FEW
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 5)), max_size=60), st.integers(0, 1000))
def test_ids_are_dense_and_ordered(spark, items, base):
    df = spark.createDataFrame(items, "k string, v int")
    out = sorted(dense_ids(df, ["k", "v"], base).collect())
    assert [r["pid"] for r in out] == list(range(base + 1, base + 1 + len(items)))
    assert [(r["k"], r["v"]) for r in out] == sorted(items)


@FEW
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.sampled_from(["u", "v", None])), max_size=30
    ),
    st.integers(0, 30),
)
def test_map_does_not_depend_on_the_batches(spark, seen, cut):
    ddl = "event_id int, ip string, at int, user string"
    events = [(n, *e) for n, e in enumerate(seen)]
    order = ["at", "event_id"]
    whole = ip_user_map(spark.createDataFrame(events, ddl), order)
    first = ip_user_map(spark.createDataFrame(events[:cut], ddl), order)
    both = ip_user_map(spark.createDataFrame(events[cut:], ddl), order, prior=first)
    assert rows(both) == rows(whole)
    want = {}
    for n, ip, at, user in sorted(events, key=lambda e: (e[2], e[0])):
        if ip is not None and user is not None:
            want[f"ip_{ip}"] = user
    assert {r["key"]: r["user"] for r in whole.collect()} == want


@FEW
@given(st.dictionaries(st.integers(0, 9), st.integers(0, 99)), st.dictionaries(st.integers(0, 9), st.integers(0, 99)))
def test_offsets_never_fall_below_the_earliest(spark, earliest, stored):
    make = lambda d: spark.createDataFrame(list(d.items()), "part int, off long")
    got = {r["part"]: r["off"] for r in resume_offsets(make(earliest), make(stored)).collect()}
    assert got == {p: max(o, stored.get(p, o)) for p, o in earliest.items()}
