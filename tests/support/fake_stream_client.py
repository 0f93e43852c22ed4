"""A stand-in record-stream client for sink tests: appends each call's
records to a JSON-lines file named by the ``fake_log`` option."""

import json
import os


class _Client:
    def __init__(self, log):
        self.log = log

    def put_records(self, StreamName, Records):  # noqa: N803 (client API names)
        with open(self.log, "a") as f:
            f.write(json.dumps({"stream": StreamName, "pid": os.getpid(),
                                "records": [[r["PartitionKey"], r["Data"].decode()] for r in Records]}) + "\n")
        return {"FailedRecordCount": 0}


def factory(options):
    return _Client(options["fake_log"])


class _Throttling(_Client):
    """Rejects every third record of a call the first time it is sent."""

    def __init__(self, log):
        super().__init__(log)
        self.refused = set()

    def put_records(self, StreamName, Records):  # noqa: N803 (client API names)
        taken, answer = [], []
        for i, r in enumerate(Records):
            if i % 3 == 0 and r["Data"] not in self.refused:
                self.refused.add(r["Data"])
                answer.append({"ErrorCode": "ProvisionedThroughputExceededException"})
            else:
                taken.append(r)
                answer.append({"SequenceNumber": "1"})
        super().put_records(StreamName, taken)
        return {"FailedRecordCount": len(Records) - len(taken), "Records": answer}


def throttling(options):
    return _Throttling(options["fake_log"])
