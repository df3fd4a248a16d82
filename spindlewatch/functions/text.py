"""Text forms: delimited fields, numbers, and the lines written to logs."""

from pyspark.sql import functions as F

from spindlewatch import names


def comma_fields(line):
    """Fields of a comma-separated line. There is no quoting, fields are not trimmed, and empty fields
    at the end of the line do not count."""
    return F.split(F.regexp_replace(line, ",+$", ""), ",", -1)


def float_or_null(text):
    """A float written as a Java float literal, surrounding blanks allowed; null for any other text.

    The cast also takes ``inf`` and any capitalisation of the special values, which the literal form does not.
    """
    special = F.trim(text).rlike("(?i)^[+-]?(inf|infinity|nan)$")
    exact = F.trim(text).rlike("^[+-]?(Infinity|NaN)$")
    return F.when(~special | exact, text.try_cast("float"))


def received_line(serial):
    return F.format_string(names.RECEIVED_TEXT, serial)


def control_line(serial, label):
    """What the controller reports for a label; null for labels it does not act on."""
    return F.when(label == names.RED, F.format_string(names.RED_TEXT, serial)).when(
        label == names.GREEN, F.format_string(names.GREEN_TEXT, serial)
    )


# Fixed formats: the printed forms of an event and of a status row.
_EVENT_FORMAT = (
    "MachineEvent{serialNum='%s', timestamp=%d, bitRPM=%d, bitTemp=%d, "
    "bitPositionX=%d, bitBitPositionY=%d, bitPositionZ=%d}"
)
_STATUS_FORMAT = "MachineStatus{serialNumber='%s', averageBitTemp10s=%d, eventTime=%d}"


def event_line(row=""):
    """Printed form of an event; ``row`` is the prefix of its columns (``"event."`` for a struct column)."""
    fields = ("serialNum", "eventTime", "bitRPM", "bitTemp", "bitPositionX", "bitPositionY", "bitPositionZ")
    return F.format_string(_EVENT_FORMAT, *[F.col(row + name) for name in fields])


def status_line(row=""):
    """Printed form of a status row."""
    fields = ("serialNumber", "averageBitTemp10s", "eventTime")
    return F.format_string(_STATUS_FORMAT, *[F.col(row + name) for name in fields])
