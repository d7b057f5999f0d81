"""A chat client that answers offline, by the length of what it is asked."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class OfflineClient:
    """Rates and summarizes; texts of some lengths are irrelevant or fail for good."""

    def request(self, payload):
        system, user = (message["content"] for message in payload["messages"])
        text = user.split("\n\n", 1)[1]
        size = len(text)
        if size % 13 == 0:
            raise ConnectionError("no answer")
        if "Rating: X/10" in system:
            reply = "Not relevant" if size % 7 == 0 else f"Length {size}. Rating: {size % 101 / 10}/10"
        else:
            reply = f" 共{size}chars "
        return {"choices": [{"message": {"content": reply}}]}
