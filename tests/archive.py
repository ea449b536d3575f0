"""A tiny archive whose results were worked out by hand."""

import gzip
import json
from pathlib import Path

PUSH, WATCH, FORK, PULL = "PushEvent", "WatchEvent", "ForkEvent", "PullRequestEvent"

NO_REPO = object()

# (day, hour) -> [(type, repository, user, number of events)]
COUNTS = {
    ("2019-06-27", 0): [
        (PUSH, "a/x", "u1", 12),
        (PUSH, "b/y", "u2", 10),
        (PUSH, "c/z", "u1", 6),
        (PUSH, "c/z", "u2", 6),
        (WATCH, "a/x", "u3", 6),
        (WATCH, "b/y", "u3", 5),
        (FORK, "b/y", "u3", 5),
        (FORK, "a/x", "u3", 4),
        ("IssuesEvent", "a/x", "u3", 3),
    ],
    ("2019-06-27", 23): [
        (PUSH, "a/x", "u1", 8),
        (PUSH, "b/y", "u2", 11),
        (WATCH, "a/x", "u3", 6),
        (WATCH, "c/z", "u3", 8),
    ],
    ("2019-06-28", 5): [(PUSH, "a/x", "u1", 20)],
}
# (repository, language or NO_REPO for a pull request without head repository)
PULLS = {
    ("2019-06-27", 0): [
        ("a/x", "Python"),
        ("a/x", "Go"),
        ("a/x", "Go"),
        ("b/y", None),
        ("c/z", NO_REPO),
        ("d/w", "Scala"),
    ]
}


def event(number, day, hour, kind, repo, user):
    return {
        "id": str(number),
        "type": kind,
        "created_at": f"{day}T{hour:02}:{number % 60:02}:00Z",
        "actor": {"login": user, "id": 1},
        "repo": {"name": repo, "id": 2},
        "payload": {"size": 1},
        "public": True,
    }


def pull(number, day, hour, repo, language):
    row = event(number, day, hour, PULL, repo, "u3")
    head = None
    if language is not NO_REPO:
        head = {
            "language": language,
            "open_issues_count": number,
            "forks": 2 * number,
            "has_wiki": number % 2 == 0,
            "stargazers_count": 3 * number,
            "watchers_count": 4 * number,
            "fork": True,
        }
    row["payload"] = {"action": "opened", "pull_request": {"head": {"ref": "x", "repo": head}}}
    return row


def lines(hour_key):
    day, hour = hour_key
    rows, number = [], 0
    for kind, repo, user, count in COUNTS.get(hour_key, []):
        for _ in range(count):
            number += 1
            rows.append(json.dumps(event(number, day, hour, kind, repo, user)))
    for repo, language in PULLS.get(hour_key, []):
        number += 1
        rows.append(json.dumps(pull(number, day, hour, repo, language)))
    if hour_key == ("2019-06-27", 0):
        rows.append("{bad")
    return rows


def put(landing, day, hour, rows, compressed=False, flat=False, name=None):
    folder = Path(landing) if flat else Path(landing) / day
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / (name or f"{day}-{hour}.json{'.gz' if compressed else ''}")
    data = "".join(row + "\n" for row in rows).encode()
    path.write_bytes(gzip.compress(data) if compressed else data)
    return path


def put_hour(landing, hour_key, **how):
    return put(landing, *hour_key, lines(hour_key), **how)


def put_all(landing, **how):
    for hour_key in COUNTS:
        put_hour(landing, hour_key, **how)
