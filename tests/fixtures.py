"""Golden scenario: three accounts, four folders, eight object contents.

Fixed values: contents, names, sizes and hashes must give the published outcome of this scenario.
"""

import hashlib

from pyspark.sql import functions as F

ACCOUNTS = ["pro", "release", "dev"]

MAP_ROWS = [
    ("s3://cars/europe/spain", "s3://cars/europe/spain", "s3://cars_dev/europe/spain"),
    ("s3://pets/dogs/big_size", "s3://pets/dogs/big_size", "s3://pets_dev/dogs/size/heavy"),
    ("s3://pets/horses/europe", "s3://pets/horses/europe", "s3://pets_dev/horses/europe"),
    ("s3://pets/non-existent-prefix", "s3://pets/non-existent-prefix", "s3://pets_dev/non-existent-prefix"),
]

CONTENT = {
    "C1": "brand,model,year\ncupra,ateca,2018\nseat,1400,1953\n",
    "C2": "name,weight\nnoah,30\n",
    "C3": "name,weight\njohn,40\njane,40\n",
    "C4": "name,weight\nalf,33\n",
    "C5": "name,weight\nnoah,30\nbruce,42\npeter,37\n",
    "C6": "name,weight\nfoo,1\nbar,20\nbaz,3\nqux,4\nquux,5\n",
    "C7": "name,weight\nris,33\nwilly,28\n",
    "C8": "name,age,category,country\nlu,3,a,spain\nrik,2,b,france\nlis,4,a,italy\n",
}

# (account, bucket, key, content id)
OBJECTS = [
    ("pro", "cars", "europe/spain/cars-20241014.csv", "C1"),
    ("pro", "pets", "dogs/big_size/dogs-20240914.csv", "C2"),
    ("pro", "pets", "dogs/big_size/dogs-20241015.csv", "C3"),
    ("pro", "pets", "dogs/big_size/dogs-20241019.csv", "C2"),
    ("release", "cars", "europe/spain/cars-20241014.csv", "C1"),
    ("release", "pets", "dogs/big_size/dogs-20240914.csv", "C2"),
    ("release", "pets", "dogs/big_size/dogs-20241015.csv", "C3"),
    ("release", "pets", "dogs/big_size/dogs-20241019.csv", "C5"),
    ("release", "pets", "dogs/big_size/dogs-20241020-test.csv", "C6"),
    ("dev", "cars_dev", "europe/spain/cars-20241014.csv", "C1"),
    ("dev", "pets_dev", "dogs/size/heavy/dogs-20240914.csv", "C2"),
    ("dev", "pets_dev", "dogs/size/heavy/dogs-20241015.csv", "C4"),
    ("dev", "pets_dev", "dogs/size/heavy/dogs-20241019.csv", "C2"),
    ("dev", "pets_dev", "dogs/size/heavy/dogs-20241021.csv", "C7"),
    ("dev", "pets_dev", "horses/europe/horses-20210219.csv", "C8"),
]

# (bucket, prefix, name, hash release, hash dev, can exist release)
EXPECTED_RULES = [
    ("cars", "europe/spain/", "cars-20241014.csv", True, True, None),
    ("pets", "dogs/big_size/", "dogs-20240914.csv", True, True, None),
    ("pets", "dogs/big_size/", "dogs-20241015.csv", True, False, None),
    ("pets", "dogs/big_size/", "dogs-20241019.csv", False, True, None),
    ("pets", "dogs/big_size/", "dogs-20241020-test.csv", False, None, False),
    ("pets", "dogs/big_size/", "dogs-20241021.csv", None, False, None),
    ("pets", "horses/europe/", "horses-20210219.csv", None, False, None),
    ("pets", "non-existent-prefix/", None, None, None, None),
]


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def wide_map(spark, rows=MAP_ROWS, accounts=ACCOUNTS):
    return spark.createDataFrame(rows, ", ".join(f"`{a}` string" for a in accounts))


def raw_entries(spark, objects=OBJECTS):
    rows = [(a, b, k, len(CONTENT[c].encode()), '"' + md5(CONTENT[c]) + '"') for a, b, k, c in objects]
    df = spark.createDataFrame(rows, "account string, bucket string, key string, size long, etag string")
    return df.select("account", "bucket", "key", F.lit("2024-10-14 08:49:01").cast("timestamp").alias("last_modified"), "size", "etag")


def write_object_tree(root: str, objects=OBJECTS):
    """Write the objects as files: <root>/<account>/<bucket>/<key>."""
    import os

    for a, b, k, c in objects:
        path = os.path.join(root, a, b, k)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", newline="") as f:
            f.write(CONTENT[c])
