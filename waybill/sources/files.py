"""Files and folders on whatever file system a path names, by Hadoop's interface."""


def file_system(spark, path):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark, path):
    fs, place = file_system(spark, path)
    return fs.exists(place)


def make_folder(spark, path):
    fs, folder = file_system(spark, path)
    fs.mkdirs(folder)


def listed(spark, path, pattern):
    """Names in a folder that match, with the status of each, in the order of the names."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return {}
    statuses = {status.getPath().getName(): status for status in fs.listStatus(folder)}
    return {name: statuses[name] for name in sorted(statuses) if pattern.fullmatch(name)}


def delete(spark, *paths):
    for path in paths:
        fs, place = file_system(spark, path)
        fs.delete(place, True)


def move(spark, source, target):
    """Let a folder appear under another name, whole. A `target` from before goes first."""
    fs, place = file_system(spark, target)
    fs.delete(place, True)
    fs.mkdirs(place.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), place):
        raise OSError(f"{source} could not become {target}")
