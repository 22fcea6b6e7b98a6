"""Column functions: text, time, money, record generators and the wire format."""
