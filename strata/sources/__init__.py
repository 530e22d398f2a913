"""Sources: feed fetches (A1-A4) over pluggable transports; layer tables are read by ``TableStore``."""

from .asking import Answer, AskPolicy  # noqa: F401
from .feeds import keyed_fetch, list_head, page_entries, paged_feed, responses  # noqa: F401
from .live import Feeds, live_feeds  # noqa: F401
from .transports import HttpTransport, MemoryTransport, PageFiles, TableTransport  # noqa: F401
from .walk import resumed_feed  # noqa: F401
