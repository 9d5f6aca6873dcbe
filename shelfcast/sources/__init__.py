"""Input schemas, readers, sinks and the derived test inputs."""
