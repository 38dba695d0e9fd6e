"""Fixed rows of the fixtures, and rows of a DataFrame in a fixed order."""

# The reference's two text fixtures and its in-code collection.
SENSOR_LINES = [
    "sensor1,1547718199,0.89",
    "sensor1,1547719099,5.6",
    "sensor1,1547729799,78.6",
    "sensor4,1547740199,35.6",
    "sensor4,1547740199,88",
    "sensor4,1547740199,99",
    "sensor4,1547740199,66",
    "sensor4,1547740199,55",
]
HELLO_LINES = ["hello flink", "hello java", "hello scala", "my name", "how are you", "ha ha ha"]
COLLECTION = [("sensor1", 1547718199, 55.5), ("sensor2", 1547719099, 5.6),
              ("sensor3", 1547729799, 78.6), ("sensor4", 1547740199, 35.6)]


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
