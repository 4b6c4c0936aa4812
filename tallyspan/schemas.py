"""Fixed schemas of the tables the engine reads and writes."""

from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)

RL_ROW = T.StructType(
    [
        T.StructField("data_source", T.StringType()),
        T.StructField("prompt", MESSAGES),
        T.StructField("ability", T.StringType()),
        T.StructField(
            "reward_model",
            T.StructType([T.StructField("style", T.StringType()), T.StructField("ground_truth", T.StringType())]),
        ),
        T.StructField(
            "extra_info",
            T.StructType(
                [
                    T.StructField("split", T.StringType()),
                    T.StructField("index", T.LongType()),
                    T.StructField("answer", T.StringType()),
                    T.StructField("question", T.StringType()),
                ]
            ),
        ),
    ]
)

CORPUS_ROW = T.StructType(
    [
        T.StructField("idx", T.LongType()),
        *[
            T.StructField(n, T.StringType())
            for n in ("kind", "dataset", "answer", "elo", "prompt", "description", "tests")
        ],
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("system", T.StringType()),
    ]
)

TESTS = T.StructType(
    [
        T.StructField("inputs", T.ArrayType(T.StringType())),
        T.StructField("outputs", T.ArrayType(T.StringType())),
        T.StructField("testtype", T.StringType()),
        T.StructField("fn_name", T.StringType()),
        T.StructField("time_limit", T.StringType()),
    ]
)

# chosen / rejected may be a text or a list of messages in the files: read as JSON text
PREFERENCE_ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("prompt", "chosen", "rejected")])
UNPAIRED_ROW = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("completion", T.StringType()),
        T.StructField("label", T.BooleanType()),
    ]
)
CHAT_ROW = T.StructType([T.StructField("messages", MESSAGES)])

METRIC_ROW = T.StructType(
    [T.StructField("step", T.LongType()), T.StructField("data", T.MapType(T.StringType(), T.DoubleType()))]
)
EXPERIMENT_POINT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("step", T.LongType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
    ]
)
CORPUS_DOC = T.StructType([T.StructField("id", T.StringType()), T.StructField("contents", T.StringType())])
