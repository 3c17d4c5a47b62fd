"""Every foreign row is in its table or in the audit list."""

import pytest

from lendgrade.operators import audit
from lendgrade.sources.readers import read_csv_checked, read_entity_csv_checked
from lendgrade.sources.schemas import ENTITY_DDL

DDL = "id int, name string, amount float, note string"
LINES = ["1,a,2.5,x", "2,b,much,x", "3,c,,", "4,d", "5,e,1,x,more", "x,f,1,", ",g,1,", "", '6,"h, i",7,"q ""r"""']


def _rows(spark, tmp_path, required):
    spark.createDataFrame([(v,) for v in LINES], "value string").coalesce(1).write.mode("overwrite").text(str(tmp_path / "f"))
    return read_csv_checked(spark, str(tmp_path / "f"), DDL, required, header=False)


def test_rows_are_accepted_or_listed_with_reasons(spark, tmp_path):
    rows = _rows(spark, tmp_path, ("id",))
    assert sorted(map(tuple, audit.accepted(rows).collect())) == [(1, "a", 2.5, "x"), (2, "b", None, "x"), (3, "c", None, None), (6, "h, i", 7.0, 'q "r"')]
    listed = {r.record: (sorted(r.reasons), r.rejected) for r in audit.audit_list(rows, "t").collect()}
    assert listed["4,d"] == listed["5,e,1,x,more"] == (["malformed line"], True)
    assert listed['{"id":"2","name":"b","amount":"much","note":"x"}'] == (["amount: not a float"], False)
    assert listed['{"id":"x","name":"f","amount":"1"}'] == (["id: not a int"], True)
    assert listed['{"name":"g","amount":"1"}'] == (["id: missing"], True)
    assert len(listed) == 5
    counts = {(r.reason, r.rejected): r.total for r in audit.audit_counts(audit.audit_list(rows, "t")).collect()}
    assert counts == {("malformed line", True): 2, ("amount: not a float", False): 1, ("id: not a int", True): 1, ("id: missing", True): 1}
    # nothing is lost: blank lines are no rows
    assert audit.accepted(rows).count() + audit.audit_list(rows, "t").where("rejected").count() == len(LINES) - 1


def test_malformed_lines_are_seen_whatever_columns_are_read(spark, tmp_path):
    rows = _rows(spark, tmp_path, ())
    assert rows.where(audit.REJECTED).select(audit.REASONS).count() == 2
    assert rows.select(audit.REJECTED).where(audit.REJECTED).count() == 2


def test_required_columns_of_the_entities_and_wrong_schemas(spark, tmp_path):
    spark.createDataFrame([("1,100,1,0,,20,,",), ("2,1,1,0,9,9,,",)], "value string").write.text(str(tmp_path / "r"))
    rows = read_entity_csv_checked(spark, str(tmp_path / "r"), "repayments", header=False)
    assert [r.loan_id for r in audit.accepted(rows).collect()] == ["2"]
    assert [r.reasons for r in audit.audit_list(rows, "repayments").collect()] == [["total_payment_received: missing"]]
    with pytest.raises(ValueError):
        audit.checked(spark.range(1), ENTITY_DDL["loans"])
    with pytest.raises(KeyError):
        audit.checked(spark.createDataFrame([("1", None)], "a string, _corrupt_record string"), "a int", ["b"])
