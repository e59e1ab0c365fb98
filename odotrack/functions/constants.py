"""Values the results depend on."""

# Physical conversions and limits that the tables are defined with.
TICKS_TO_METERS = 0.001745
METERS_PER_DEGREE = 111000.0
LONGITUDE_FACTOR = 0.7
SESSION_GAP = "5 seconds"
RESAMPLE_EVERY = "1 second"
WATERMARK = "1 minutes"
SENSORS = ("IMU", "ENCODER", "GPS")

# Fallback quality thresholds used when no metadata table can be read.
FALLBACK_ACCEL_X = 15.0
FALLBACK_VELOCITY = 45.0
