"""The driver's tables mapped to the robot model, and the registered queries with their oracle SQL."""
