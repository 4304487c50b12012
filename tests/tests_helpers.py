"""What several tests share."""

from pyspark.sql import functions as F


def now():
    return F.lit("2026-04-25 00:00:00").cast("timestamp_ntz")


def menu(title, date, place="Denver, CO"):
    return f'<div class="menu-event-single"><div class="menu-event-title"><a href="/{title}">{title}</a></div><div class="event-date">{date}</div><div class="location">{place}</div></div>'


def fetch(url):
    if url.endswith("fail"):
        raise TimeoutError("no answer")
    return None if url.endswith("none") else f"body of {url}{'!' * 40 if url.endswith('long') else ''}".encode()
