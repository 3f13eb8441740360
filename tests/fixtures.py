"""Small synthetic inputs with the traps listed in FIXTURES.md."""

from __future__ import annotations

import datetime as dt
import json
import os

UTC = dt.timezone.utc


def ms(y, mo, d, h=0, mi=0, s=0, milli=0) -> int:
    return int(dt.datetime(y, mo, d, h, mi, s, milli * 1000, tzinfo=UTC).timestamp() * 1000)


SONGS = [
    # same artist with two locations
    dict(num_songs=1, artist_id="AR1", artist_latitude=None, artist_longitude=None, artist_location="",
         artist_name="Line Renaud", song_id="SO1", title="Der Kleine Dompfaff", duration=152.92036, year=0),
    dict(num_songs=1, artist_id="AR1", artist_latitude=48.8, artist_longitude=2.3, artist_location="Paris",
         artist_name="Line Renaud", song_id="SO2", title="Other Song", duration=200.0, year=1999),
    # same song_id in two files (identical record)
    dict(num_songs=1, artist_id="AR2", artist_latitude=None, artist_longitude=None, artist_location="NYC",
         artist_name="Band", song_id="SO3", title="Hit", duration=180.5, year=2001),
    dict(num_songs=1, artist_id="AR2", artist_latitude=None, artist_longitude=None, artist_location="NYC",
         artist_name="Band", song_id="SO3", title="Hit", duration=180.5, year=2001),
    # same title and artist, another duration
    dict(num_songs=1, artist_id="AR2", artist_latitude=None, artist_longitude=None, artist_location="NYC",
         artist_name="Band", song_id="SO4", title="Hit", duration=181.0, year=2002),
    # same (title, artist, duration) under two song ids
    dict(num_songs=1, artist_id="AR3", artist_latitude=None, artist_longitude=None, artist_location=None,
         artist_name="Twins", song_id="SO6", title="Echo", duration=99.5, year=2010),
    dict(num_songs=1, artist_id="AR3", artist_latitude=None, artist_longitude=None, artist_location=None,
         artist_name="Twins", song_id="SO5", title="Echo", duration=99.5, year=2010),
]


def log(ts, page="NextSong", user="10", session=182, item=0, song=None, artist=None, length=None,
        level="free", first="Ann", last="Lee", gender="F"):
    return dict(artist=artist, auth="Logged In", firstName=first, gender=gender, itemInSession=item,
                lastName=last, length=length, level=level, location="Here, CA", method="PUT", page=page,
                registration=1.5e12, sessionId=session, song=song, status=200, ts=ts,
                userAgent="agent", userId=user)


LOGS_NOV = [
    log(ms(2018, 11, 4, 10, 0, 0, 250), item=0, song="Hit", artist="Band", length=180.5),  # Sunday, ms set
    log(ms(2018, 11, 4, 10, 0, 0, 900), item=1, song="Echo", artist="Twins", length=99.5),  # same second
    log(ms(2018, 11, 4, 10, 5, 0), item=2, song=None, artist=None, length=None),  # NULL song
    log(ms(2018, 11, 4, 10, 6, 0), item=3, page="Home"),  # not a play
    log(ms(2018, 11, 4, 10, 7, 0), item=4, user="", page="Home", first=None, last=None),  # logged out
    log(ms(2018, 11, 4, 10, 8, 0), item=5, song="Unknown", artist="Nobody", length=1.0),
]
LOGS_DEC = [
    # level change free -> paid for user 10; last week of December
    log(ms(2018, 12, 31, 23, 59, 59), session=183, item=0, song="Der Kleine Dompfaff", artist="Line Renaud",
        length=152.92036, level="paid", first="Annie"),
    log(ms(2018, 12, 30, 12, 0, 0), user="11", session=300, item=0, song="Hit", artist="Band", length=181.0,
        first="Bob", last="Ray", gender="M"),
    log(ms(2018, 12, 30, 12, 1, 0), user=None, session=301, item=0, song="Hit", artist="Band", length=181.0),
]


def write_json_lines(path: str, records) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def write_song_tree(root: str) -> str:
    """song_data/A/B/C/<song>.json, one record per file, three levels."""
    base = os.path.join(root, "song_data")
    for i, rec in enumerate(SONGS):
        sub = os.path.join(base, "A", "B" if i % 2 else "C", "D" if i < 4 else "E")
        write_json_lines(os.path.join(sub, f"TR{i:03d}.json"), [rec])
    return base


def write_log_tree(root: str) -> str:
    """log_data/2018/11/*.json and log_data/2018/12/*.json."""
    base = os.path.join(root, "log_data")
    write_json_lines(os.path.join(base, "2018", "11", "2018-11-04-events.json"), LOGS_NOV)
    write_json_lines(os.path.join(base, "2018", "12", "2018-12-31-events.json"), LOGS_DEC)
    return base
