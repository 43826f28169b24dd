"""The judged pairs of titles are stored, so that the joins after them do not judge every pair anew."""

from pressroom.operators import history as hist
from pressroom.plans import standins as sd


def test_pairs_are_judged_once(spark, small):
    judged = hist.block_repeats(sd.open_candidates(spark, small), sd.published_history(spark, small), sd.AS_OF, classes=sd.EVENT_CLASSES)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan and "arrays_overlap" not in plan
    assert judged.filter("status <> 'kept'").count() > 0
