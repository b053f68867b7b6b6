"""Job/stage durations from a Spark event log folder (zstd or plain): python tools/eventlog_stages.py DIR"""
import glob
import io
import json
import sys

import zstandard


def lines(path):
    raw = open(path, "rb")
    if path.endswith(".zstd"):
        stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        stream = io.TextIOWrapper(raw, encoding="utf-8")
    yield from stream


def main(folder):
    stages, jobs = {}, {}
    for f in glob.glob(f"{folder}/**/events_*", recursive=True):
        for line in lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:48], si["Number of Tasks"],
                                          round((si["Completion Time"] - si["Submission Time"]) / 1000, 2))
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"], None]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][2] = (e["Completion Time"] - jobs[e["Job ID"]][0]) / 1000
    t0 = min(v[0] for v in jobs.values())
    for j, (st, ids, dur) in sorted(jobs.items()):
        print(f"job {j:4d} at {(st - t0) / 1000:7.1f}s took {dur or 0:6.2f}s",
              [stages[i] for i in ids if i in stages])


if __name__ == "__main__":
    main(sys.argv[1])
