"""Class ids, task instructions and dataset rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.plans.staging import join_staged

# Dataset name to task code; any other name is DEFAULT_TASK.
TASK_OF_DATASET = {
    "ustc-tfc-2016": "EMD",
    "iscx-botnet": "BND",
    "iscx-vpn-2016": "EVD",
    "lfett-2021": "EVD",
    "dohbrw-2020": "MDD",
    "iscx-tor-2016": "TBD",
    "dapt-2020": "APT",
}
DEFAULT_TASK = "EAC"
GRANULARITY = "session"

# Instruction and label text of each task. {granularity} and {label} are filled in.
TASK_TEMPLATES = [
    (
        "EMD",
        "Given the following traffic data <{granularity}> that contains protocol fields, traffic features, and payloads of the first five packets in a session and the session statistical features. Please conduct the ENCRYPTED MALWARE DETECTION TASK to determine which application category the encrypted beign or malicious traffic belongs to. The categories include 'FTP, Gmail, SMB, Weibo, Cridex, Geodo, Htbot, Miuref, Neris, Nsis-ay, Shifu, Tinba, Virut, Zeus'.",  # noqa: E501
        "{label}",
    ),
    (
        "EAC",
        "Given the following traffic data <{granularity}> that contains protocol fields, traffic features, and payloads. Please conduct the ENCRYPTED APP CLASSIFICATION TASK to determine which APP category the encrypted traffic belongs to. ",  # noqa: E501
        "{label}",
    ),
    (
        "BND",
        "Given the following traffic data <{granularity}> that contains protocol fields, traffic features, and payloads. Please conduct the BOTNET DETECTION TASK to determine which type of network the traffic belongs to. The categories include 'IRC, Neris, RBot, Virut, normal'.",  # noqa: E501
        "{label}",
    ),
    (
        "EVD",
        "Given the following traffic data <{granularity}> that contains protocol fields, traffic features, and payloads. Please conduct the ENCRYPTED VPN DETECTION TASK to determine which behavior or application category the VPN encrypted traffic belongs to. The categories include 'aim, bittorrent, email, facebook, ftps, hangout, icq, netflix, sftp, skype, spotify, vimeo, voipbuster, youtube'.",  # noqa: E501
        "{label}",
    ),
    (
        "MDD",
        "Below is a traffic {granularity}. Please conduct the malicious DoH detection task: ",
        "The traffic category is likely to be recognized as {label}.",
    ),
    (
        "TBD",
        "Given the following traffic data <{granularity}> that contains protocol fields, traffic features, and payloads. Please conduct the TOR BEHAVIOR DETECTION TASK to determine which behavior or application category the traffic belongs to under the Tor network. The categories include 'audio, browsing, chat, file, mail, p2p, video, voip'.",  # noqa: E501
        "{label}",
    ),
    (
        "APT",
        "Given the following traffic data <{granularity}> that contains protocol fields, traffic features, and payloads. Please conduct the APT DETECTION TASK to determine which behavior or application category the traffic belongs to under the APT attacks. The categories include 'APT and normal'.",  # noqa: E501
        "{label}",
    ),
]
# Fixed value: what stands between the instruction and the session text (backslash, letter n).
INPUT_MARK = "\\n<{granularity}>: "


def task_of(dataset_name: Column) -> Column:
    """Task code of a column of dataset names."""
    codes = F.create_map(*[F.lit(x) for pair in TASK_OF_DATASET.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, dataset_name), F.lit(DEFAULT_TASK))


def label_dictionary(classes: DataFrame, name: str = "class") -> DataFrame:
    """``str_label, label``: distinct classes numbered 0…n-1 in name order.

    Only the distinct names (as many as the classifier has outputs) are numbered.
    """
    return (
        classes.select(F.col(name).alias("str_label"))
        .where(F.col("str_label").isNotNull())
        .distinct()
        .withColumn(
            "label", (F.row_number().over(Window.orderBy("str_label")) - 1).cast("int")
        )
    )


def with_instruction(
    rows: DataFrame,
    templates: list[tuple[str, str, str]] = TASK_TEMPLATES,
    granularity: str = GRANULARITY,
) -> DataFrame:
    """Add ``instruction, label_format`` for the ``task`` of each row.

    The few templates are constants of the plan. A task without one is an error
    of the caller.
    """
    missing = F.raise_error(F.concat(F.lit("no template for task "), F.col("task")))

    def constant(part: int) -> Column:
        texts = F.create_map(*[F.lit(x) for row in templates for x in (row[0], row[part])])
        return F.coalesce(F.try_element_at(texts, F.col("task")), missing)

    return rows.withColumn(
        "instruction", F.replace(constant(1), F.lit("{granularity}"), F.lit(granularity))
    ).withColumn("label_format", constant(2))


def template_of(
    task: str, templates: list[tuple[str, str, str]] = TASK_TEMPLATES, granularity: str = GRANULARITY
) -> tuple[str, str]:
    """Instruction (granularity filled in) and label format of one task."""
    for code, instruction, label_format in templates:
        if code == task:
            return instruction.replace("{granularity}", granularity), label_format
    raise ValueError(f"no template for task {task}")


def dataset_rows(
    sessions: DataFrame,
    labels: DataFrame,
    template: tuple[str, str],
    granularity: str = GRANULARITY,
) -> DataFrame:
    """``class, flow_key, inputs, labels, str_labels`` of one task from sessions with ``text``.

    Only the class dictionary is joined; the template of a task is a constant.
    """
    instruction, label_format = template
    head = instruction + INPUT_MARK.replace("{granularity}", granularity)
    named = labels.withColumnRenamed("str_label", "class")
    return join_staged(sessions, named, ["class"]).select(
        "class",
        "flow_key",
        F.concat(F.lit(head), "text").alias("inputs"),
        F.col("label").alias("labels"),
        F.replace(F.lit(label_format), F.lit("{label}"), F.col("class")).alias("str_labels"),
    )
