"""Row functions in Python that need something expensive to set up."""


def map_with_resource(df, open_resource, function, schema):
    """Apply ``function(resource, frame)`` to the rows of ``df`` in Arrow batches, as pandas frames.

    ``open_resource`` is called once per task, and the resource is closed afterwards if it can be. This is
    for what no built-in function does; those stay in the JVM and need no resource.
    """

    def run(frames):
        resource = open_resource()
        try:
            for frame in frames:
                yield function(resource, frame)
        finally:
            if hasattr(resource, "close"):
                resource.close()

    return df.mapInPandas(run, schema)
