"""Table shapes, fixed values and run options shared by the whole package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The six system flags, in the order in which they are printed.
SYSTEM_FLAGS = ["SEEN", "FLAGGED", "ANSWERED", "DRAFT", "DELETED", "RECENT"]

# The six outputs a row can be routed to.
SUCCESS = "success"
ATTACHMENTS = "attachments"
PARSE_ERROR = "parse-error"
RETRY = "retry"
FAILURE = "failure"
ORIGINAL = "original"
OUTPUTS = [SUCCESS, ATTACHMENTS, PARSE_ERROR, RETRY, FAILURE, ORIGINAL]

# What a fetch returns.
HEADERS_ONLY = "HEADERS_ONLY"
FULL_MESSAGE = "FULL_MESSAGE"
ATTACHMENTS_ONLY = "ATTACHMENTS_ONLY"

# Header fields in the order in which they are read. A field that cannot be
# read hides itself and every field after it.
HEADER_ORDER = [
    "subject", "from", "to", "cc", "received", "sent",
    "flags", "size", "message_id", "in_reply_to",
]

#: One landed mail before MIME parsing.
RAW = T.StructType([
    T.StructField("folder", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("received_ts", T.TimestampType()),
    T.StructField("size", T.LongType()),
    T.StructField("raw", T.BinaryType()),
])

HEADER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
])

#: One leaf of the MIME tree, or a container that could not be opened.
PART = T.StructType([
    T.StructField("part_path", T.ArrayType(T.IntegerType())),
    T.StructField("part_index", T.IntegerType()),
    T.StructField("disposition", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("container", T.BooleanType()),
    T.StructField("fault", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

#: One row per landed mail, readable or not.
MESSAGE = T.StructType([
    T.StructField("folder", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("msg_num", T.LongType()),
    T.StructField("received_ts", T.TimestampType()),
    T.StructField("size", T.LongType()),
    T.StructField("flags", T.ArrayType(T.StringType())),
    T.StructField("message_id", T.StringType()),
    T.StructField("in_reply_to", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("from_all", T.ArrayType(T.StringType())),
    T.StructField("sender_all", T.ArrayType(T.StringType())),
    T.StructField("to_all", T.ArrayType(T.StringType())),
    T.StructField("cc_all", T.ArrayType(T.StringType())),
    T.StructField("bcc_all", T.ArrayType(T.StringType())),
    T.StructField("sent_ts", T.TimestampType()),
    T.StructField("headers", T.ArrayType(HEADER)),
    T.StructField("header_fault", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("body_fault", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("parts", T.ArrayType(PART)),
])

FOLDER = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("holds_messages", T.BooleanType()),
    T.StructField("holds_folders", T.BooleanType()),
])

CURSOR = T.StructType([
    T.StructField("state_folder", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("last_uid", T.LongType()),
])

#: One row of the log of marks: what a step did to a message.
MARK = T.StructType([
    T.StructField("folder", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("read", T.BooleanType()),
    T.StructField("deleted", T.BooleanType()),
])

#: UIDs of a folder, one bit each in blocks of 32,768.
ID_SET = T.StructType([
    T.StructField("folder", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("bits", T.BinaryType()),
])

REQUEST = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("folder", T.StringType()),
    T.StructField("recursive", T.BooleanType()),
    T.StructField("max_recursion_depth", T.IntegerType()),
    T.StructField("state_folder", T.StringType()),
    T.StructField("batch_size", T.IntegerType()),
    T.StructField("fetch_mode", T.StringType()),
    T.StructField("include_headers", T.BooleanType()),
    T.StructField("include_attachments", T.BooleanType()),
    T.StructField("incremental", T.BooleanType()),
    T.StructField("max_message_size", T.LongType()),
    T.StructField("max_attachment_size", T.LongType()),
    T.StructField("max_attachments", T.IntegerType()),
    T.StructField("max_retries", T.IntegerType()),
    T.StructField("retry_backoff_ms", T.LongType()),
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("retry_last_time_ms", T.LongType()),
])


@dataclass(frozen=True)
class FetchOptions:
    """Options of one run over a mailbox, with their default values."""

    folder: str = "INBOX"
    recursive: bool = False
    max_recursion_depth: int = 5
    fetch_mode: str = FULL_MESSAGE
    include_headers: bool = True
    include_attachments: bool = False
    batch_size: int = 10
    incremental: bool = False
    state_folder: str | None = "INBOX"
    max_message_size: int = 100 * 1024 * 1024
    max_attachment_size: int = 50 * 1024 * 1024
    max_attachments: int = 100
    mark_read: bool = False
    delete_messages: bool = False
    max_retries: int = 3
    retry_backoff_ms: int = 10_000

    #: A run returns at most this many batches per folder.
    BATCHES_PER_RUN = 10

    def checked(self) -> FetchOptions:
        """These options, or an error that names the first rule they break."""
        files = self.include_attachments
        for broken, rule in (
            (not self.folder or not self.folder.strip(), "the folder cannot be empty"),
            (self.fetch_mode not in (HEADERS_ONLY, FULL_MESSAGE, ATTACHMENTS_ONLY),
             f"there is no fetch mode {self.fetch_mode}"),
            (self.batch_size <= 0, "the batch size has to be positive"),
            (self.max_message_size <= 0, "the largest message size has to be positive"),
            (files and self.max_attachment_size <= 0,
             "the largest attachment size has to be positive"),
            (files and self.max_attachment_size > self.max_message_size,
             "an attachment cannot be larger than the largest message"),
            (files and self.max_attachments <= 0,
             "the number of attachments has to be positive"),
            (self.max_retries < 0, "the number of retries cannot be negative"),
            (self.retry_backoff_ms <= 0, "the wait before a retry has to be positive"),
            (self.fetch_mode == ATTACHMENTS_ONLY and not files,
             "attachments alone cannot be fetched while attachments are left out"),
            (self.max_recursion_depth == 0 or self.max_recursion_depth < -1,
             "recursion depth has to be positive, or -1 for any depth"),
        ):
            if broken:
                raise ValueError(rule)
        return self

    @property
    def state_key_base(self) -> str:
        return self.folder if self.state_folder is None else self.state_folder
