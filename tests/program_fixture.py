"""A small deterministic program-operations dataset over three days (May 1-3, 2027)."""

import datetime as dt
from decimal import Decimal as D

from starloom.plans import schemas


def ts(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)


T0 = ts("2027-04-30T08:00:00")


def day1_rows():
    return {
        "centers": [(1, "Center One", "Tehran", "Addr 1", True, T0, None), (2, "Center Two", "Shiraz", "Addr 2", True, T0, None)],
        "children": [(1, 1, "Ali", "A", None, d("2020-01-01"), "m", d("2026-09-01"), "active", T0, None),
                     (2, 1, "Sara", "B", None, d("2020-02-01"), "f", d("2026-09-01"), "active", T0, None),
                     (3, 2, "Reza", "C", None, d("2019-03-01"), "m", d("2026-09-01"), "active", T0, None)],
        "teachers": [(1, 1, "Mina", "T", None, None, "active", True, T0, None),
                     (2, 2, "Omid", "T", None, None, "", True, T0, None)],
        "users": [(1, "mina", "x", "teacher", 1, True, T0, None), (2, "omid", "x", "teacher", 2, True, T0, None)],
        "domains": [(1, "Language", None, True, T0, None), (2, "Math", None, True, T0, None)],
        "score_scales": [(1, "Ten", D("0.00"), D("10.00"), None, True, T0, None)],
        "task_templates": [(1, 1, "Read words", None, 1, True, 1, T0, None)],
        "closure_reasons": [(1, "Holiday", None, True, T0, None)],
        "absence_reasons": [(1, "Sick", None, True, T0, None)],
        "no_score_reasons": [(1, "Child refused", "child did not answer", True, T0, None),
                             (2, "System outage", None, True, T0, None)],
        "center_daily_status": [(1, 2, d("2027-05-01"), "closed", 1, None, 2, ts("2027-05-01T07:00:00"), None)],
        "child_daily_status": [(1, 2, d("2027-05-01"), "absent", 1, None, 1, ts("2027-05-01T07:00:00"), None)],
        "child_task_plans": [(1, 1, 1, 1, "Read words", 1, d("2027-05-01"), None, True, 1, T0, None),
                             (2, 3, None, 2, "Count to ten", 1, d("2027-05-01"), None, True, 2, T0, None)],
        "daily_task_assignments": [
            (1, 1, d("2027-05-01"), 1, 1, 1, "Read words", 1, 1, "completed", ts("2027-05-01T09:00:00"), None),
            (2, 2, d("2027-05-01"), 1, 1, 1, "Read words", 1, 1, "planned", ts("2027-05-01T09:00:00"), None),
            (3, 3, d("2027-05-01"), 2, None, 2, "Count to ten", 1, 2, "cancelled", ts("2027-05-01T09:00:00"), None)],
        "assessment_sessions": [(1, 1, 1, 1, d("2027-05-01"), ts("2027-05-01T10:00:00"), ts("2027-05-01T10:30:00"),
                                 "done", None, ts("2027-05-01T10:00:00"), None)],
        "task_assessments": [(1, 1, 1, 1, 1, d("2027-05-01"), D("8.00"), None, "scored", None, 1, None,
                              ts("2027-05-01T10:10:00"), None)],
        "notes": [], "note_batches": [], "note_batch_items": [], "audit_logs": [],
    }


def day2_rows():
    r = day1_rows()
    r["centers"][0] = (1, "Center One", "Karaj", "Addr 1b", True, T0, ts("2027-05-02T06:00:00"))   # SCD2 change
    r["teachers"][1] = (2, 2, "Omid", "T", None, None, "on_leave", True, T0, ts("2027-05-02T06:00:00"))
    r["daily_task_assignments"] += [
        (4, 1, d("2027-05-02"), 1, 1, 1, "Read words", 1, 1, "completed", ts("2027-05-02T09:00:00"), None),
        (5, 3, d("2027-05-02"), 2, None, 2, "Count to ten", 1, 2, "incomplete", ts("2027-05-02T09:00:00"), None)]
    r["assessment_sessions"].append((2, 3, 2, 2, d("2027-05-02"), None, None, "done", None, ts("2027-05-02T10:00:00"), None))
    r["task_assessments"] += [
        (2, 4, 1, 1, 1, d("2027-05-02"), D("6.00"), None, "scored", None, 1, None, ts("2027-05-02T10:10:00"), None),
        (3, 5, 2, 3, 2, d("2027-05-02"), None, None, "not_scored", 1, 1, None, ts("2027-05-02T10:20:00"), None)]
    return r


def sources(spark, rows):
    return {t: schemas.from_rows(spark, t, v) for t, v in rows.items()}
