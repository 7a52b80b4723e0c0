"""Column functions: arrays, geometry, text, frame indices, schedules."""
