"""ISO-8601 durations of days and shorter."""

from __future__ import annotations

import re
from datetime import timedelta

_FORM = re.compile(r"P(?:(\d+)D)?(?:T(?=\d)(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?")


def parse_duration(text: str) -> timedelta:
    """'P1DT6H' -> timedelta; years and months are refused, they have no fixed length."""
    m = _FORM.fullmatch(text.strip())
    if not m or not any(m.groups()):
        raise ValueError(f"not a duration of days, hours, minutes and seconds: {text!r}")
    days, hours, minutes, seconds = (int(x or 0) for x in m.groups())
    return timedelta(days=days, hours=hours, minutes=minutes, seconds=seconds)


def format_duration(d: timedelta) -> str:
    hours, rest = divmod(d.seconds, 3600)
    minutes, seconds = divmod(rest, 60)
    time = "".join(f"{n}{u}" for n, u in ((hours, "H"), (minutes, "M"), (seconds, "S")) if n)
    date = f"{d.days}D" if d.days else ""
    return f"P{date}{'T' + time if time else ''}" if date or time else "PT0S"
