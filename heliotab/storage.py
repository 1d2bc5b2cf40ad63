"""Settings for remote destinations; credentials come from the caller, never from code."""

from __future__ import annotations

from collections.abc import Mapping


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
) -> dict[str, str]:
    """Session settings for an S3-compatible store reached through ``s3a://`` paths.

    Without keys the default credential chain of the file system connector applies.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
    return conf


def object_store_conf_from(env: Mapping[str, str]) -> dict[str, str]:
    """The same, from environment-like variables; no endpoint means no settings."""
    endpoint = env.get("OBJECT_STORE_ENDPOINT")
    if not endpoint:
        return {}
    return object_store_conf(
        endpoint, env.get("OBJECT_STORE_ACCESS_KEY"), env.get("OBJECT_STORE_SECRET_KEY")
    )
