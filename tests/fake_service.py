"""A paged service over an SQLite file, which writes down what it is asked."""

import json
import sqlite3


def fetch(url, p):
    with open(url + "/requests", "a") as f:
        f.write(json.dumps(p) + "\n")
    con = sqlite3.connect(url + "/service.db")
    con.row_factory = sqlite3.Row
    if "returnCountOnly" in p:
        return json.dumps({"count": con.execute("SELECT count(*) FROM t WHERE " + p["where"]).fetchone()[0]})
    if "outStatistics" in p:
        low, high = con.execute("SELECT min(ID), max(ID) FROM t WHERE " + p["where"]).fetchone()
        return json.dumps({"features": [{"attributes": {"min_id": low, "max_id": high}}]})
    rows = con.execute(f"SELECT {p['outFields']} FROM t WHERE {p['where']} ORDER BY ID LIMIT ? OFFSET ?", (p["resultRecordCount"], p["resultOffset"])).fetchall()
    return json.dumps({"features": [{"attributes": dict(r)} for r in rows], "objectIdFieldName": "ID"})
