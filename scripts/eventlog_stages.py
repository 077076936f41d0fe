"""Summarise a Spark event log: per job, its stages with task count and wall time.

usage: python scripts/eventlog_stages.py <event-log-file> [max_jobs]
"""

import json
import sys


def main():
    path = sys.argv[1]
    limit = int(sys.argv[2]) if len(sys.argv) > 2 else 50
    import glob
    import os

    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    stages, jobs, sql = {}, [], {}

    def read(fp):
        if fp.endswith(".zstd"):
            import io

            import zstandard

            with open(fp, "rb") as raw:
                data = zstandard.ZstdDecompressor().stream_reader(raw).read()
            return io.StringIO(data.decode("utf-8"))
        return open(fp)

    lines = (line for fp in files for line in read(fp))
    if True:
        for line in lines:
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                stages[info["Stage ID"]] = (info["Stage Name"][:60], info["Number of Tasks"], round(dur, 3))
            elif ev == "SparkListenerJobStart":
                jobs.append([e["Job ID"], e["Submission Time"], None, e.get("Stage IDs", []),
                             e.get("Properties", {}).get("spark.sql.execution.id")])
            elif ev == "SparkListenerJobEnd":
                for j in jobs:
                    if j[0] == e["Job ID"]:
                        j[2] = e["Completion Time"]
            elif ev == "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart":
                sql[str(e["executionId"])] = (e["time"], e.get("description", "")[:50])
            elif ev == "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd":
                if str(e["executionId"]) in sql:
                    t0, d = sql[str(e["executionId"])]
                    sql[str(e["executionId"])] = (t0, d, (e["time"] - t0) / 1000)
    for j in jobs[:limit]:
        dur = ((j[2] or j[1]) - j[1]) / 1000
        st = [stages[s] for s in j[3] if s in stages]
        print(f"job {j[0]} sql={j[4]} {dur:.2f}s", st)


if __name__ == "__main__":
    main()
