"""Layout name -> DataFrame transform. A new layout is one more function here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from jobsignal.operators import chat as chat_ops
from jobsignal.plans import datasets

# Inputs: typed chat messages, mails (date, html), pages (url, html), statistic messages.
LAYOUTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "chat": datasets.extract_chat,
    "mail": datasets.extract_mail,
    "web": datasets.extract_web,
    "statistic": chat_ops.extract_statistics,
}
