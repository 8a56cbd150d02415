"""Small files and folders by URI, on any file system that the driver can open: cards, manifests, queues."""

from __future__ import annotations

import os

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str) -> str:
    """``path`` as a URI. One without a scheme is a file of this machine, which only a local master may use."""
    if "://" in path or path.startswith("file:"):
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"{path} names no file system that all executors share; give a URI")
    return f"file://{os.path.abspath(path)}"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (or of a path of this machine), as this process reaches it, and the path there."""
    uri = os.fspath(uri)
    if "://" in uri and not uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    # a path stands for itself, blanks and per cent signs included
    return pafs.LocalFileSystem(), os.path.abspath(uri.removeprefix("file:").replace("//", "/", 1) if uri.startswith("file:") else uri)


def join(uri: str, *more: str) -> str:
    return "/".join([uri.rstrip("/"), *more])


def exists(uri: str) -> bool:
    fs, path = filesystem(uri)
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def is_file(uri: str) -> bool:
    fs, path = filesystem(uri)
    return fs.get_file_info(path).type == pafs.FileType.File


def read(uri: str) -> str:
    fs, path = filesystem(uri)
    with fs.open_input_stream(path) as f:
        return f.read().decode("utf-8")


def write(uri: str, text: str) -> None:
    """The file ``uri`` with its folders; another file takes its place only when it is whole."""
    fs, path = filesystem(uri)
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/.{name}.part") as f:
        f.write(text.encode("utf-8"))
    fs.move(f"{folder}/.{name}.part", path)


def delete(uri: str) -> None:
    """The folder goes, if there is one."""
    fs, path = filesystem(uri)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def files(uri: str) -> list[pafs.FileInfo]:
    """The file, or all files below the folder, in order of path; none if there is nothing."""
    fs, path = filesystem(uri)
    info = fs.get_file_info(path)
    if info.type != pafs.FileType.Directory:
        return [info] if info.type == pafs.FileType.File else []
    found = fs.get_file_info(pafs.FileSelector(path, recursive=True))
    return sorted((x for x in found if x.type == pafs.FileType.File), key=lambda x: x.path)


def drop_checksums(uri: str) -> None:
    """A local folder's checksums of its files, which an edit by hand would break, go."""
    fs, path = filesystem(uri)
    for x in fs.get_file_info(pafs.FileSelector(path)):
        if x.base_name.startswith(".") and x.base_name.endswith(".crc"):
            fs.delete_file(x.path)
