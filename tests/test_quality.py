from pricemill.operators import quality as Q


def test_each_kind_finds_its_row(make, rows):
    df = make(
        [(1, "a", 1), (1, "b", 2), (None, "b", None), (None, "c", 9), (3, "a", 1), (1, "a", 5)],
        "id int, kind string, parent int",
    )
    parents = {"p": make([(1,), (2,), (5,), (1,)], "key int")}
    checks = [
        Q.not_null("id"),
        Q.accepted("kind", ["a", "b"]),
        Q.unique("id"),
        Q.unique_combination("id", "kind"),
        Q.relationship("parent", "p", "key"),
    ]
    report = {r["check"]: r["violations"] for r in Q.run_checks("m", df, checks, parents).collect()}
    assert report == {
        "not_null(id)": 2,
        "accepted(kind)": 1,
        "unique(id)": 1,
        "unique_combination(id, kind)": 1,
        "relationship(parent)": 1,
    }
    assert rows(Q.violations(df, checks[2])) == [(1, 3)]
    assert rows(Q.violations(df, checks[4], parents), "parent") == [(9,)]


def test_row_checks_share_one_scan(make):
    df = make([(1, "a")], "id int, kind string")
    report = Q.run_checks("m", df, [Q.not_null("id"), Q.not_null("kind"), Q.accepted("kind", ["a"])])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
