from fixtures import action, actions, rows

from footfall.operators import categories as K


def table(spark):
    return actions(
        spark,
        [
            action("a", 1, click_category_id=1),
            action("a", 2, click_category_id=1),
            action("a", 3, click_category_id=2),
            action("b", 1, click_category_id=2),
            action("b", 2, click_category_id=2),
            action("b", 3, click_category_id=1),
            action("b", 4, click_category_id=5),
            action("a", 4, order_category_ids="3,3,4"),
            action("a", 5, order_category_ids="2,x"),
            action("b", 5, pay_category_ids="6"),
            action("b", 6, pay_category_ids="4,4"),
            action("c", 6),
        ],
    )


def test_counts(spark):
    t = table(spark)
    assert rows(K.category_click_counts(t)) == [(1, 3), (2, 3), (5, 1)]
    assert rows(K.category_order_counts(t)) == [(2, 1), (3, 2), (4, 1)]
    assert rows(K.category_pay_counts(t)) == [(4, 2), (6, 1)]
    assert rows(K.category_ids(t)) == [(i,) for i in range(1, 7)]


def test_top_categories_break_ties_by_order_then_pay_then_id(spark):
    activity = K.category_activity(table(spark))
    got = [tuple(r) for r in K.top_categories(activity).collect()]
    assert got == [
        (2, 3, 1, 0), (1, 3, 0, 0), (5, 1, 0, 0), (3, 0, 2, 0), (4, 0, 1, 2), (6, 0, 0, 1),
    ]
    assert [r[0] for r in K.top_categories(activity, 2).collect()] == [2, 1]


def test_top_sessions(spark):
    activity = K.category_activity(table(spark))
    top = K.top_categories(activity, 2)
    assert rows(K.top_sessions_per_category(activity, top, 1)) == [(1, "a", 2), (2, "b", 2)]
    assert rows(K.top_sessions_per_category(activity, None, 3)) == [
        (1, "a", 2), (1, "b", 1), (2, "a", 1), (2, "b", 2), (5, "b", 1),
    ]


def test_tie_at_the_cut_goes_by_session(spark):
    t = actions(spark, [action(s, 1, click_category_id=1) for s in "dcba"])
    got = K.top_sessions_per_category(K.category_activity(t), None, 3)
    assert rows(got) == [(1, "a", 1), (1, "b", 1), (1, "c", 1)]


def test_activity_of_selected_sessions(spark):
    activity = K.category_activity(table(spark))
    only = spark.createDataFrame([("b",)], "session_id string")
    assert rows(K.activity_of(activity, only).select("category_id", "click_count")) == [
        (1, 1), (2, 2), (4, 0), (5, 1), (6, 0),
    ]
