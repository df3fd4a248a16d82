"""Acting on the control topic."""

from spindlewatch import names
from spindlewatch.operators.controls import actionable, routed
from spindlewatch.operators.lookup import unmatched_keys


def start_controller(controls, machines, profiles, act, report, checkpoint, trigger=None):
    """Start the query that turns control messages (key, value) into actions.

    ``machines`` and ``profiles`` are functions without arguments that give the running machines (column
    ``serialNum``) and the profile table; they are read again for every micro-batch. ``act`` is called with
    the actions of a micro-batch and its id, ``report`` with the machines that messages were for and that
    are not running.
    """

    def step(messages, batch_id):
        kept = messages.persist()
        try:
            running = machines()
            act(routed(kept, running, profiles()), batch_id)
            report(unmatched_keys(actionable(kept).withColumnRenamed("key", "serialNum"), running), batch_id)
        finally:
            kept.unpersist()

    return (
        controls.writeStream.queryName("machine controls")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": names.CONTROL_INTERVAL}))
        .foreachBatch(step)
        .start()
    )
