import pytest

from quizlens.operators import knowledge as kn
from quizlens.sources.dimensions import jdbc_options


def test_conditions_stay_in_the_join(spark):
    knowledge = spark.createDataFrame(
        [(1, "a", 1, 1), (2, "b", 1, 0), (3, "c", 2, 1), (4, "d", 1, 1), (5, "e", 1, 1)],
        "id bigint, name string, level int, status int")
    links = spark.createDataFrame([(1, 7, 1), (1, 8, 1), (2, 7, 1), (3, 7, 1), (4, 7, 0)],
                                  "knowledge_id bigint, subject_id int, status int")
    points = kn.knowledge_subject(knowledge, links)
    assert sorted(map(tuple, points.collect())) == [(0, 2, "b"), (0, 4, "d"), (0, 5, "e"), (7, 1, "a"), (8, 1, "a")]
    lists = kn.subject_points(points)
    assert {r.subject: (r.points, r.point_names) for r in lists.collect()} == {
        0: ("2,4,5", "b,d,e"), 7: ("1", "a"), 8: ("1", "a")}
    rows = spark.createDataFrame([(1, 7), (2, 99)], "user_id bigint, subject int")
    got = {r.user_id: (r.points, r.point_names) for r in kn.attach_subject_points(rows, lists).collect()}
    assert got == {1: ("1", "a"), 2: ("", "")}


def test_last_contact_wins_and_is_masked(spark):
    users = spark.createDataFrame([(1, "13800000001", 2), (1, "13800000002", 1), (2, None, 1)],
                                  "user_id bigint, reg_phone string, updated bigint")
    got = {r.user_id: r for r in kn.user_contacts(users, "updated").collect()}
    assert got[1].phone_masked == "138****0001" and len(got[1].phone_hash) == 64
    assert got[2].phone_hash is None
    rows = spark.createDataFrame([(1, 5), (3, 5)], "user_id bigint, subject int")
    assert kn.attach_contacts(rows, kn.user_contacts(users, "updated")).count() == 2


def test_jdbc_options():
    connection = {"url": "jdbc:x:y", "user": "u", "password": "p"}
    options = jdbc_options(connection, "knowledge", split_on="id", lower=0, upper=100, parts=4)
    assert options["dbtable"] == "knowledge" and options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    assert "partitionColumn" not in jdbc_options(connection, "knowledge")
    with pytest.raises(ValueError):
        jdbc_options({}, "knowledge")
    with pytest.raises(ValueError):
        jdbc_options(connection, "knowledge", split_on="id")
