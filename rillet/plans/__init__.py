"""End-to-end flows built from the operators, plus their driver-table inputs."""
